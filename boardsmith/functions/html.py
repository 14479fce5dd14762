"""HTML extraction as expressions on a string column.

Markup is split once into events (start tags, end tags, texts); comments, scripts, styles and declarations are left out.
One fold over the tags keeps a stack of what is open and gives every element its end: an end tag closes the nearest open
element of its name and whatever is still open inside it, an end tag of nothing open is ignored, and what is open at
the end of the page ends there.  So an element ends at its own end tag, however deep elements of its name are nested.

A parsed page is its events and its elements, (first, last, parent) places of events.  A path of ``Step``s goes from the page to
elements: each step filters the descendants (or children) of the elements so far by tag name, classes, or place among the children.

The text of an element is its texts, each with entities decoded and white space at both ends removed, joined without a separator.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from boardsmith.functions.text import py_strip
from boardsmith.functions.util import as_col

# Comments, scripts, styles, declarations, and a tag that the end of the page cuts.
DROPPED = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)|<[!?][^>]*>|</?[a-z][^<>]*+\z"
ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')"""
TAG = rf"</?[A-Za-z]{ATTRIBUTES}*+>|</?[A-Za-z][^>]*+>"  # the second form for quotes that never close
EVENT = rf"(?s){TAG}|(?:[^<]++|<(?!/?[A-Za-z]))++"

# Elements that have no content and no end tag.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
DEFAULT = "N/A"

ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

NAMES = "\n".join(f"{name}\t{chr(point)}" for name, point in [*sorted(name2codepoint.items()), ("apos", ord("'"))])  # HTML 4 and apos


@dataclass(frozen=True)
class Step:
    """Elements with a tag name (any if None), all of some classes, and the ``nth`` place among the children of their parent.

    ``child`` asks for children of the elements so far instead of descendants; ``nth`` implies it.
    """

    tag: str | None = None
    classes: tuple[str, ...] = ()
    child: bool = False
    nth: int | None = None


def step(tag: str | None = None, *classes: str, child: bool = False, nth: int | None = None) -> Step:
    return Step(tag, tuple(classes), child or nth is not None, nth)


TEXT, START, END, EMPTY = range(4)  # kinds of events; an empty element has no end tag


def events(c) -> Column:
    """The texts and tags of a page in order, each (kind, name, classes, markup): tags are taken apart once, here."""
    def named(e):
        return F.struct(F.when(e.startswith("<"), F.lower(F.regexp_extract(e, r"\A</?([A-Za-z][^\s/>]*)", 1))).otherwise("").alias("name"), e.alias("markup"))

    def told(e):
        name, markup = e["name"], e["markup"]
        kind = F.when(name == "", TEXT).when(markup.startswith("</"), END).when(markup.endswith("/>") | name.isin(*VOID), EMPTY).otherwise(START)
        classes = F.when((name != "") & markup.rlike("(?i)class"), F.split(F.coalesce(attribute(markup, "class"), F.lit("")), r"\s+"))
        return F.struct(kind.alias("kind"), name.alias("name"), classes.alias("classes"), markup.alias("markup"))

    return F.transform(F.transform(F.regexp_extract_all(F.regexp_replace(as_col(c), DROPPED, ""), F.lit(EVENT), 0), named), told)


_ELEMENTS = "array<struct<first:int,last:int,parent:int>>"


def _tree(ev: Column) -> Column:
    """(first, last, parent) of every element in document order; the page is the parent -1."""
    def closed(ids, left, at):
        """The open elements from place ``left`` on, ended at ``at``."""
        parent = lambda k: F.when(k + left > 0, F.get(ids, k + left - 1)).otherwise(-1)
        return F.transform(F.slice(ids, left + 1, F.size(ids)), lambda x, k: F.struct(x.alias("first"), at.alias("last"), parent(k).alias("parent")))

    def fold(st, at):
        e = F.get(ev, at)
        name, ids, depth = e["name"], st["ids"], F.size(st["ids"])
        parent = F.when(depth > 0, F.get(ids, depth - 1)).otherwise(-1)
        left = depth - F.array_position(F.reverse(st["names"]), name).cast("int")  # what stays open below the end tag's element
        same = lambda **new: F.struct(*[new.get(k, st[k]).alias(k) for k in ("names", "ids", "done")])
        started = same(names=F.array_append(st["names"], name), ids=F.array_append(ids, at))
        empty = same(done=F.array_append(st["done"], F.struct(at.alias("first"), at.alias("last"), parent.alias("parent"))))
        ended = same(names=F.slice(st["names"], F.lit(1), left), ids=F.slice(ids, F.lit(1), left), done=F.concat(st["done"], closed(ids, left, at)))
        return (F.when(e["kind"] == START, started).when(e["kind"] == EMPTY, empty)
                .when(F.array_contains(st["names"], name), ended).otherwise(st))

    start = F.struct(F.array().cast("array<string>").alias("names"), F.array().cast("array<int>").alias("ids"), F.array().cast(_ELEMENTS).alias("done"))
    tags = F.filter(F.transform(ev, lambda e, i: F.when(e["kind"] != TEXT, i)), lambda i: i.isNotNull())
    end = lambda st: F.array_sort(F.concat(st["done"], closed(st["ids"], F.lit(0), F.size(ev))))
    return F.aggregate(tags, start, fold, end)


def page(c) -> Column:
    """A parsed page: its events and its elements.  Put it in a column of its own, so that it is computed once."""
    return F.get(F.transform(F.array(events(c)), lambda ev: F.struct(ev.alias("events"), _tree(ev).alias("tree"))), F.lit(0))


def attribute(e, name: str) -> Column:
    """The value of an attribute of a start tag, entities decoded (null if it has none)."""
    value = F.regexp_substr(as_col(e), F.lit(rf"""(?is)(?<=[\s"'/]){name}\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)"""))
    value = F.regexp_replace(value, r"(?is)\A[^=]*=\s*", "")
    return unescape(F.regexp_replace(value, r"""(?s)\A(["'])(.*)\1\z""", "$2"))


def _matches(e: Column, s: Step) -> Column:
    out = F.lit(True) if s.tag is None else e["name"] == s.tag.lower()
    for c in s.classes:
        out = out & e["classes"].isNotNull() & F.array_contains(e["classes"], c)
    return out


def _inside(pg: Column, scope: Column, s: Step) -> Column:
    """Elements of one step inside ``scope``."""
    def fits(o):
        inside = (o["parent"] == scope["first"]) if s.child else (o["first"] > scope["first"]) & (o["last"] <= scope["last"])
        out = inside & _matches(F.get(pg["events"], o["first"]), s)
        if s.nth is not None:
            before = F.filter(pg["tree"], lambda x: (x["parent"] == o["parent"]) & (x["first"] < o["first"]))
            out = out & (F.size(before) == s.nth - 1)
        return out

    return F.filter(pg["tree"], fits)


def elements(pg: Column, path: Sequence[Step], scope: Column | None = None) -> Column:
    """The elements at the end of ``path`` in a parsed page, in document order, each once."""
    found = None if scope is None else F.array(scope)
    for s in path:
        if found is None:
            found = _inside(pg, F.struct(F.lit(-1).alias("first"), F.lit((1 << 31) - 1).alias("last")), s)
        else:
            found = F.array_sort(F.array_distinct(F.flatten(F.transform(found, _finder(pg, s)))))
    return F.array(F.struct(F.lit(-1).alias("first"), F.size(pg["events"]).alias("last"), F.lit(-1).alias("parent"))) if found is None else found


def _finder(pg: Column, s: Step):
    return lambda scope: _inside(pg, scope, s)


def _once(c, use) -> Column:
    """``use(page)`` with the page parsed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(page(c)), use), F.lit(0))


def _code_point(number: Column) -> Column:
    valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("�"))


def unescape(c) -> Column:
    """Entities decoded once: decimal, hexadecimal, and the names of HTML 4; unknown names stay."""
    text = as_col(c)
    names = F.str_to_map(F.lit(NAMES), F.lit("\n"), F.lit("\t"))  # folded to a constant map

    def one(p):
        body = F.substring(p, 2, 1 << 20)
        inner = F.substring(body, F.lit(1), F.length(body) - 1)
        number = F.when(inner.rlike("^#[xX]"), F.conv(F.substring(inner, 3, 10), 16, 10)).otherwise(F.substring(inner, 2, 10)).cast("bigint")
        return F.when(~p.rlike(rf"\A{ENTITY}\z"), p).when(inner.startswith("#"), _code_point(number)).otherwise(F.coalesce(F.try_element_at(names, inner), p))

    parts = F.regexp_extract_all(text, F.lit(rf"(?s){ENTITY}|&|[^&]+"), 0)
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, one), "")).otherwise(text)


def span_text(pg: Column, element: Column) -> Column:
    """Text of an element of a parsed page."""
    inside = F.slice(pg["events"], element["first"] + 2, F.greatest(element["last"] - element["first"] - 1, F.lit(0)))
    return F.array_join(F.transform(F.filter(inside, lambda e: e["kind"] == TEXT), lambda e: py_strip(unescape(e["markup"]))), "")


def _path(tag, cls) -> list[Step]:
    if isinstance(tag, (list, tuple)):
        return list(tag)
    return [step(tag, *([cls] if isinstance(cls, str) else cls or ()))]


def text_at(pg: Column, tag: str | Sequence[Step] | None, cls: str | Sequence[str] | None = None, default: str | None = DEFAULT, scope: Column | None = None) -> Column:
    """Text of the first element at the end of a path (or with a tag name and classes); ``default`` when absent."""
    first = F.slice(elements(pg, _path(tag, cls), scope), 1, 1)  # as an array, so that it is computed once
    return F.coalesce(F.get(F.transform(first, lambda o: span_text(pg, o)), F.lit(0)), F.lit(default))


def html_text(c, tag: str | Sequence[Step] | None, cls: str | Sequence[str] | None = None, default: str | None = DEFAULT) -> Column:
    """Text of the first element; ``default`` when absent."""
    return F.when(as_col(c).isNull(), F.lit(default)).otherwise(_once(c, lambda pg: text_at(pg, tag, cls, default)))


def html_items(c, container: str | Sequence[Step] = "ul", item: str = "li", default: str | None = None) -> Column:
    """Texts of the ``item`` elements inside every ``container`` (empty array when absent)."""
    path = [*_path(container, None), step(item)]
    return _once(c, lambda pg: F.transform(elements(pg, path), lambda o: span_text(pg, o)))


def html_structs(pg: Column, path: Sequence[Step], fields: dict[str, Sequence[Step]], default: str | None = DEFAULT) -> Column:
    """For every element at the end of ``path`` a struct of texts, each the first at the end of a field's path inside it."""
    return F.transform(elements(pg, path), lambda o: F.struct(*[text_at(pg, p, None, default, o).alias(name) for name, p in fields.items()]))


def html_count(c, tag: str) -> Column:
    """Number of ``tag`` start tags (outside scripts, styles and comments)."""
    return F.size(F.filter(events(c), lambda e: (e["kind"] != END) & (e["name"] == tag.lower()))).cast("bigint")


def html_rows(df, html_col: str, container: str | Sequence[Step] = "ul", item: str = "li", fields: dict | None = None, keep: list[str] | None = None):
    """A list page -> one row per item: (keep..., pos, text, <field>...) where each field is ``name: (tag, cls)`` or a path,
    found inside that item (``'N/A'`` when the item lacks it)."""
    keep = keep or []
    pg = F.col("_page")
    rows = df.select(*keep, page(html_col).alias("_page"))
    own = lambda f: f if isinstance(f, (list,)) or isinstance(f[0], Step) else _path(*f)
    path = [*_path(container, None), step(item)]
    each = F.transform(elements(pg, path), lambda o: F.struct(
        span_text(pg, o).alias("text"), *[text_at(pg, own(f), None, DEFAULT, o).alias(name) for name, f in (fields or {}).items()]))
    return rows.select(*keep, F.posexplode(each).alias("pos", "_item")).select(*keep, F.col("pos").cast("bigint").alias("pos"), "_item.*")
