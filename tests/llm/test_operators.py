import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

import brute
from boardsmith.llm import induced_sort, near_dedup, neighbours, packing, piece_encoding, quality, secret_scan, suffix_dedup, token_counts, tokens
from boardsmith.llm.induced_sort import Sorter

WORD = P.path("word_bpe_49k.json")
PIECE = P.path("piece_bpe_32k.model")


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def frame(spark, texts):
    return spark.createDataFrame(texts, "doc_id bigint, text string")


def plain(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return frame(spark, texts)


# --- quality -----------------------------------------------------------------------------------------------------


def check_quality(df):
    got = rows_of(quality.quality_report(df), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted(((d, *brute.quality(t)) for d, t in plain(df)), key=repr)


def test_quality(docs, odd, empty):
    check_quality(docs)
    check_quality(odd)
    assert quality.quality_report(empty).count() == 0


def test_quality_random(spark):
    rng = random.Random(5)
    check_quality(frame(spark, [(i, rng.choice(" \n").join(rng.choice("ab#c") for _ in range(rng.randint(0, 40)))) for i in range(80)]))


def test_quality_filter_keeps_columns(odd, empty, docs):
    kept = quality.keep_quality(odd)
    assert kept.columns == odd.columns and kept.count() == 0 and quality.keep_quality(empty).count() == 0
    good = {r["doc_id"] for r in quality.quality_report(docs).where("kept").collect()}
    assert {r["doc_id"] for r in quality.keep_quality(docs).collect()} == good and len(good) > 100


def test_stop_words_judge_listed_languages_only(spark):
    def words(*kinds):
        return " ".join(f"{k}{i}" for i, k in zip(range(80), kinds * 80, strict=False))

    korean, polish, junk = words("게시글", "댓글"), words("słowo", "zdanie"), words("buy", "cheap")
    rows = [(1, korean, "ko"), (2, korean, None), (3, polish, "pl"), (4, junk, "en-US"), (5, junk, None), (6, " ".join(junk.split()[:12]), "en"),
            (7, junk + " the and of", "en"), (8, korean, "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    good = [1, 2, 3, 6, 7, 8]
    assert sorted(r["doc_id"] for r in quality.keep_quality(df).collect()) == good
    report = quality.quality_report(df)
    assert sorted(r["doc_id"] for r in report.where("kept").collect()) == good
    assert {tuple(r["failed_rules"]) for r in report.where("NOT kept").collect()} == {("stop_words",)}
    assert sorted(r["doc_id"] for r in quality.keep_quality(df.drop("lang")).collect()) == [1, 2, 6, 7, 8]


# --- near-duplicates ---------------------------------------------------------------------------------------------

NEAR = ("doc_id", "n_shingles", "component_id", "kept")


def check_near(df, **kw):
    width, (num, den) = kw.get("width", 3), kw.get("similarity", (85, 100))
    assert rows_of(near_dedup.near_duplicates(df, width, (num, den)), *NEAR) == sorted(brute.near(plain(df), width, num, den), key=repr)


def test_near_duplicates(docs, odd, empty):
    check_near(docs)
    check_near(odd)
    assert near_dedup.near_duplicates(empty, 3, (85, 100)).count() == 0


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def test_near_duplicates_of_many_edited_copies(spark, monkeypatch):
    rng = random.Random(1)
    texts = []
    for g in range(4):
        base = [f"g{g}x{rng.randrange(5000)}" for _ in range(rng.choice([12, 60, 200]))]
        texts += [edited(rng, base, rng.choice([0, 1, 1, 2, 4, 9])) for _ in range(40)]
    shared = " ".join(f"common{i}" for i in range(40))
    texts += [shared + " " + " ".join(f"own{rng.randrange(10**6)}" for _ in range(rng.choice([2, 8, 20]))) for _ in range(40)]
    rng.shuffle(texts)
    df = frame(spark, list(enumerate(texts)))
    check_near(df)
    check_near(df, width=5, similarity=(4, 5))
    monkeypatch.setattr(near_dedup, "GROUP_HASHES", 2_000)  # groups dealt in pairs of blocks
    check_near(df)


def test_keep_one_of_each(spark, odd):
    a = " ".join(f"a{i}" for i in range(100))
    df = spark.createDataFrame([(5, a, 1), (3, a + " end", 2), (4, "other words than these", 3), (None, a, 4)], "doc_id bigint, text string, __gone int")
    assert rows_of(near_dedup.keep_one_of_each(df), "doc_id", "__gone") == sorted([(3, 2), (4, 3), (None, 4)], key=repr)
    assert near_dedup.keep_one_of_each(odd).columns == odd.columns


def test_keep_one_of_each_by_row(spark):
    x, y, z = (" ".join(f"{c}{i}" for i in range(100)) for c in "xyz")
    rows = [(5, x), (5, x), (None, x + " end"), (5, y), (None, z), (None, z), (7, None), (7, None)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, __row int")
    one = [(5, x), (5, y), (None, z), (7, None), (7, None)]  # texts without words are no copies of each other
    got = near_dedup.keep_one_of_each(df, keep_unnamed=False)
    assert rows_of(got, "doc_id", "text") == sorted(one, key=repr) and got.columns == df.columns
    assert rows_of(near_dedup.keep_one_of_each(df), "doc_id", "text") == sorted([*one, (None, x + " end"), (None, z)], key=repr)
    lost = frame(spark, [(3, x), (5, x + " end"), (5, y)])
    assert rows_of(near_dedup.keep_one_of_each(lost), "doc_id", "text") == sorted([(3, x), (5, y)], key=repr)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = dict(rows_of(near_dedup.components(links, "chain"), "node", "label"))
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# --- suffix sorting ----------------------------------------------------------------------------------------------


def by_sorter(segments, depth, spill):
    text = np.concatenate([x for s in segments for x in (np.frombuffer(s, np.uint8).astype(np.uint16) + 1, np.zeros(1, np.uint16))])
    mask, out, at = Sorter(text, depth, spill).repeated(), [], 0
    for s in segments:
        out.append(mask[at:at + max(0, len(s) - depth + 1)].tolist())
        at += len(s) + 1
    return out


def test_suffix_dedup_deals_a_common_line_again(spark, monkeypatch):
    rng = random.Random(9)

    def noise(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    line, story = noise(30), noise(90)
    texts = [noise(rng.randint(0, 60)) + line + noise(rng.randint(0, 60)) for _ in range(120)]
    for _ in range(20):  # the line inside longer passages that repeat, cut at different places
        at, until = rng.randint(0, 30), rng.randint(60, 90)
        texts.append(noise(5) + (story[:40] + line + story[40:])[at:until + 30] + noise(rng.randint(0, 9)))
    texts += [texts[0], "ab" * 60, "ab" * 50 + "a", "a" * 70, "", None]
    df = frame(spark, [(i, t) for i, t in enumerate(texts)])
    want = sorted(brute.repeats(plain(df), 50), key=repr)
    rounds, deal = [], suffix_dedup._pieces
    monkeypatch.setattr(suffix_dedup, "_pieces", lambda least, width: (rounds.append(width), deal(least, width))[1])
    for bound in (1_000, 60):
        rounds.clear()
        monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", bound)
        got = suffix_dedup.repeat_report(df, 50)
        assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
        assert rounds and rounds == [8, 2, 1][: len(rounds)]


def test_induced_sort_random():
    rng = random.Random(3)
    for _ in range(300):
        alphabet, depth = rng.choice([b"ab", b"abc", b"a", bytes(range(97, 123))]), rng.choice([2, 3, 5, 8, 20])
        base = bytes(rng.choice(alphabet) for _ in range(60))
        segments = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) + base[rng.randint(0, 30):rng.randint(20, 60)] for _ in range(rng.randint(1, 6))]
        count = defaultdict(int)
        for s in segments:
            for i in range(len(s) - depth + 1):
                count[s[i:i + depth]] += 1
        want = [[count[s[i:i + depth]] > 1 for i in range(len(s) - depth + 1)] for s in segments]
        assert by_sorter(segments, depth, 64) == by_sorter(segments, depth, 64 << 20) == want


def test_suffix_order_sorts_only_what_is_not_told_apart(monkeypatch):
    rng, count = random.Random(4), []

    class Counting:
        def __getattr__(self, name):
            f = getattr(np, name)
            if name not in ("argsort", "lexsort"):
                return f
            return lambda a, *args, **kw: (count.append(len(a[0]) if name == "lexsort" else len(a)), f(a, *args, **kw))[1]

    passage, tail = (bytes(rng.choices(range(97, 123), k=n)) for n in (300, 40))
    segments = [bytes(rng.choices(range(97, 123), k=2_000)) + p for p in (passage, passage + tail, b"", tail, b"ab" * 150) for _ in range(2)]
    text = np.concatenate([x for s in segments for x in (np.frombuffer(s, np.uint8).astype(np.uint16) + 1, np.zeros(1, np.uint16))])
    sorter = Sorter(text, 200)
    names = sorter._names()
    monkeypatch.setattr(sorter, "_names", lambda: names)
    monkeypatch.setattr(induced_sort, "np", Counting())
    order, common = sorter._sorted_lms()
    assert sum(count) < len(names[0])  # one round over all suffixes would be as many
    raw = text.tolist()
    suffixes = [raw[i:i + 200] for i in order]
    assert suffixes == sorted(suffixes)
    for a, b, n in zip(suffixes, suffixes[1:], common[1:].tolist(), strict=False):
        assert n == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_ranges_are_joined_for_a_whole_batch():
    rng = random.Random(5)
    rows = [None, [], [(0, 5)], [(7, 9), (0, 3), (3, 7)]] + [[(lo, lo + rng.randint(1, 30)) for lo in rng.choices(range(200), k=rng.randint(0, 12))] for _ in range(200)]
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    column = pa.array([None if r is None else [{"lo": lo, "hi": hi} for lo, hi in r] for r in rows], kind)
    want = []
    for r in rows:
        spans = []
        for lo, hi in sorted(r or []):
            if spans and lo <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(hi, spans[-1][1]))
            else:
                spans.append((lo, hi))
        want.append(spans)
    assert suffix_dedup._merged(column) == want
    assert suffix_dedup._merged(column.slice(3, 50)) == want[3:53]
    assert suffix_dedup._merged(column.slice(0, 2)) == [[], []]


def test_segments_are_cut_out_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 20)
    texts = ["abcdefghij" * 3, "é" * 10, "x" * 9]
    wanted = [[(1, 2, 2, 10, 0, 4), (3, 4, 1, 30, 0, 5)], [(5, 6, 1, 8, 4, 0)], [(7, 8, 3, 9, 0, 1)]]
    fields = ("anchor", "content", "n", "size", "first", "spot")
    kind = pa.list_(pa.struct([(f, pa.int64()) for f in fields]))
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([[dict(zip(fields, w, strict=True)) for w in ws] for ws in wanted], kind)], ["text", "wanted"])
    got = list(suffix_dedup._cut_out([batch, batch.slice(2, 1)]))
    assert [b.num_rows for b in got] == [2, 2, 1]
    rows = [tuple(r.values()) for b in got for r in b.to_pylist()]
    assert rows[:4] == [(a, c, n, t.encode()[first:first + size], spot) for t, ws in zip(texts, wanted, strict=True) for a, c, n, size, first, spot in ws]
    assert rows[4] == rows[3]


REPEATS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def check_repeats(df, least):
    assert rows_of(suffix_dedup.repeat_report(df, least), *REPEATS) == sorted(brute.repeats(plain(df), least), key=repr)


def test_shorter_passages_are_told_and_not_removed(spark):
    one, two = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(450)), "".join(chr(97 + (i * i * 3 + i // 5) % 26) for i in range(300))
    rows = [(1, "x" * 30 + one + "1"), (2, one + "2"), (3, "3" + two), (4, two + "4" + "y" * 30), (5, "clean " * 5), (6, two + "4" + "y" * 30), (7, "é" * 90 + two), (8, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = suffix_dedup.repeat_report(df, 400)
    assert rows_of(got, *REPEATS) == sorted(brute.repeats(rows, 400), key=repr)
    assert dict(rows_of(got, "doc_id", "n_passage_bytes")) == {d: n for d, _, n, _, _ in brute.repeats(rows, suffix_dedup.PASSAGE)}
    assert dict(rows_of(got, "doc_id", "n_removed"))[3] == 0


def test_repeats(docs, odd, empty):
    check_repeats(docs, 400)
    check_repeats(odd, 400)
    assert suffix_dedup.repeat_report(empty, 400).count() == 0


def test_repeats_random(spark, monkeypatch):
    rng = random.Random(9)
    passages = ["".join(rng.choice("abé ") for _ in range(rng.randint(30, 300))) for _ in range(6)]
    texts = ["".join(rng.choice([*passages, "z" * 90, "".join(rng.choice("abcdefgh") for _ in range(50))]) for _ in range(rng.randint(0, 4))) for _ in range(60)]
    df = frame(spark, list(enumerate(texts)))
    check_repeats(df, 40)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 256)  # long texts in overlapping blocks
    check_repeats(df, 40)


def test_remove_repeats_keeps_whole_characters(spark, odd):
    a, b = "é" + "x" * 60, "è" + "x" * 60  # the second bytes differ, the first are equal
    df = spark.createDataFrame([(1, a, "k"), (2, b, "l"), (3, None, "m"), (4, "short", "n")], "doc_id bigint, text string, ranges string")
    got = suffix_dedup.remove_repeats(df, 50)
    assert rows_of(got, "doc_id", "text", "ranges") == sorted([(1, "é", "k"), (2, "è", "l"), (3, None, "m"), (4, "short", "n")], key=repr)
    assert suffix_dedup.remove_repeats(odd, 50).columns == odd.columns


# --- secrets -----------------------------------------------------------------------------------------------------


def check_secrets(df):
    got = rows_of(secret_scan.scan(df), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == sorted(((d, *n, digest) for d, t in plain(df) for n, digest in [brute.secrets(t)]), key=repr)


def test_secrets(docs, odd, empty):
    check_secrets(docs)
    check_secrets(odd)
    assert secret_scan.scan(empty).count() == 0


def test_secrets_random(spark):
    rng = random.Random(2)
    bits = ["token", "Secret", "API_KEY", "apikey", "passwd", "paſſword", "=", ":", " ", '"', "'", "AKIA", "AKIAX", "ABCDEF0123456789", "deadbeef" * 4, "é", "K", "abcdefgh", "x", "\n", "tokentoken"]
    check_secrets(frame(spark, [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))) for i in range(400)]))


def crc_token(prefix, body):
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = secret_scan.BASE62[d:d + 1].decode() + digits
    return prefix + body + digits


def test_checksums(spark):
    good = crc_token("ghp_", "abcdefghijklmnopqrstuvwxyz0123")
    bad = good[:-1] + ("1" if good[-1] != "1" else "2")
    text = f"{good} {bad} card 4111 1111 1111 1111 card 4111 1111 1111 1112 iban DE89 3704 0044 0532 0130 00 iban DE88 3704 0044 0532 0130 00"
    (row,) = secret_scan.scan(frame(spark, [(1, text)])).collect()
    assert [s.split(":")[0] for s in row["spans"].split(",")] == ["github", "card", "iban"]
    kind, a, b = row["spans"].split(",")[0].split(":")
    assert text[int(a):int(b)] == good


def test_redact(spark, odd):
    df = spark.createDataFrame([(1, "é password = hunter2hunter2!", 3), (2, None, 4)], "doc_id bigint, text string, spans int")
    assert rows_of(secret_scan.redact(df), "doc_id", "text", "spans") == [(1, "é [ASSIGN]!", 3), (2, None, 4)]
    assert secret_scan.redact(odd).columns == odd.columns


# --- tokens ------------------------------------------------------------------------------------------------------


def library_ids(text):
    from tokenizers import Tokenizer

    if not hasattr(library_ids, "t"):
        library_ids.t = Tokenizer.from_file(WORD)
    return library_ids.t.encode(text or "", add_special_tokens=False).ids


TRICKY = ["don't CAN'T I'VE", "Ünïcode ÀÉÎ ﬁ ² ½ ª º µ ß ẞ", "<|endoftext|>x<|STARTOFTEXT|> <|startoftext|>", "a\u0301 e\u0301\u00a0b\x85c\u200bd", "Σίσυφος ΣΑΣ", "1234 x1y2 ___ --- ''' 'tis",
          "日本語 中文 한국어", "\x1c\x1d a\x00b", "İI ıi", "😀👍🏽 ok"]


def test_word_ids_equal_the_library(texts):
    enc = tokens.Ids(WORD, capacity=50)
    assert enc.by_word
    for t in [*TRICKY, *(t for _, t in texts[:80])]:
        assert np.frombuffer(enc.ids(t.encode()), enc.dtype).tolist() == library_ids(t), t


COUNTS = ("doc_id", "n_bytes", "n_tokens", "over_limit")


def test_token_counts_and_cache(spark, docs, odd, empty, tmp):
    cache = tmp + "/cache"

    def want(df):
        return sorted(((d, len((t or "").encode()), n, n > 2048) for d, t in plain(df) for n in [len(library_ids(t))]), key=repr)

    assert rows_of(token_counts.token_counts(odd, WORD, cache), *COUNTS) == want(odd)
    first = spark.read.parquet(cache).count()
    assert rows_of(token_counts.token_counts(odd, WORD, cache), *COUNTS) == want(odd)
    assert spark.read.parquet(cache).count() == first  # nothing is encoded twice
    assert rows_of(token_counts.token_counts(docs, WORD, cache), *COUNTS) == want(docs)
    assert spark.read.parquet(cache).groupBy("content_digest").count().where("count > 1").count() == 0
    assert token_counts.token_counts(empty, WORD, cache).count() == 0


def test_token_counts_of_pieces(spark, odd, tmp):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = rows_of(token_counts.token_counts(odd, PIECE, tmp + "/c", fold_space=False), "doc_id", "n_tokens")
    assert got == sorted(((d, len(lib.encode(t or ""))) for d, t in plain(odd)), key=repr)


def test_pieces(spark, docs, odd, empty):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    df = docs.unionByName(odd.select("doc_id", "text")).unionByName(frame(spark, [(1000 + i, t) for i, t in enumerate([*TRICKY, "▁ ▁▁a  b   ", "<s></s><unk><0x41>", "  lead", "trail  ", "\t\n\r"])]))
    want = []
    for d, t in plain(df):
        ids = lib.encode(t or "")
        want.append((d, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(lib.decode(ids) if ids else "")))
    assert rows_of(piece_encoding.encode_pieces(df, PIECE), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert piece_encoding.encode_pieces(empty, PIECE).count() == 0
    a = piece_encoding.Agenda(PIECE)
    for _, t in plain(df):
        [a.chunks[c] for c in a.parts(t or "")]
    a.check()
    assert a.disagreed == 0


def check_packing(df, capacity=4096):
    rows = packing.pack(df, WORD, capacity=capacity, with_ids=True).collect()
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] > 0
        seqs[r["sequence_id"]].append(r)
        pieces[r["doc_id"], r["doc_tokens"]].append(r)
    pad = 0
    for own in seqs.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        pad += 0 if at & (at - 1) == 0 else capacity - at
    want = defaultdict(int)
    for d, t in plain(df):
        want[d, tuple([*library_ids(t), 2])] += 1
    got = defaultdict(int)
    for (d, n), own in pieces.items():
        own.sort(key=lambda r: (r["sequence_id"], r["offset"]))
        ids = []
        for r in own:
            assert r["start"] == len(ids)
            ids += r["ids"]
            if len(ids) == n:
                got[d, tuple(ids)] += 1
                ids = []
        assert not ids
    assert got == want
    return pad, sum(r["length"] for r in rows)


def test_packing(docs, odd, empty, monkeypatch):
    pad, total = check_packing(docs)
    assert pad <= 0.03 * total
    check_packing(odd)
    monkeypatch.setattr(packing, "SEGMENT", 5_000)
    pad, total = check_packing(docs, 256)
    assert pad <= 0.08 * total
    assert packing.pack(empty, WORD).count() == 0


def test_cuts_are_least_cost():
    rng = np.random.default_rng(4)
    for _ in range(60):
        pos = np.unique(np.concatenate([[0], np.cumsum(rng.integers(1, 9, rng.integers(1, 40)))]))
        pen = rng.integers(0, 6, len(pos))
        pen[-1] = 0
        capacity = 16
        cost = lambda a, b, j: (0 if (n := int(b - a)) & (n - 1) == 0 else capacity - n) + int(pen[j]) + packing.PER_SEQUENCE
        best = [0.0] + [float("inf")] * (len(pos) - 1)
        for j in range(1, len(pos)):
            best[j] = min((best[i] + cost(pos[i], pos[j], j) for i in range(j) if pos[j] - pos[i] <= capacity), default=float("inf"))
        cuts = packing.plan_cuts(pos, pen, capacity)
        index = {int(p): i for i, p in enumerate(pos)}
        assert sum(cost(a, b, index[b]) for a, b in zip(cuts, cuts[1:])) == best[-1]


# --- neighbours --------------------------------------------------------------------------------------------------


def exact(ids, vectors, q, k):
    d = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), d[i]) for i in order]


def test_neighbours_recall(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = df.collect()
    ids, vectors = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    got = defaultdict(list)
    for r in neighbours.nearest(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    hits = total = 0
    for i, q in enumerate(ids):
        if q % 20:
            continue
        want = exact(ids, vectors, i, 10)
        assert [x[2] for x in got[q]] == list(range(1, 11))
        assert all(abs(s - np.sqrt(((vectors[list(ids).index(v)] - vectors[i]) ** 2).sum())) < 1e-12 for v, s, _ in got[q])
        hits += len({v for v, _ in want} & {v for v, _, _ in got[q]})
        total += 10
    assert hits >= 0.97 * total


def test_neighbours_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (0, [1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS query_id", "2 AS score", "3 AS dim")
    got = rows_of(neighbours.nearest(df, df.where("vec_id % 100 = 0")), "query_id", "rank", "vec_id")
    assert got == [(0, 1, 1), (0, 2, 2)]
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def test_batches_of_texts_have_the_ids_of_each_text():
    import numpy as np
    import public_tokenizers
    import pyarrow as pa

    from boardsmith.llm import packing, tokens

    texts = ["  a  b ", "", " ", "\t\n", "x\x1cy\x0bz", "É ü İstanbul", "a <|endoftext|> b", "It's 3.5%", "word " * 300]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        path = public_tokenizers.path(name)
        one, many = tokens.Ids(path), tokens.Ids(path)
        for part in (texts, [t for t in texts if "<|" not in t], []):
            ids, ends = many.batch(pa.array(part, pa.string()))
            want = [one.lib.encode(t, add_special_tokens=False).ids for t in part]
            assert [x.tolist() for x in np.split(ids, ends[:-1])][: len(part)] == want
    assert list(packing.slices(pa.array(texts))) == [(0, len(texts))]


def test_every_sentence_end_may_be_a_cut():
    import numpy as np

    from boardsmith.llm import packing

    classes = np.zeros(1000, np.uint8)
    classes[[9, 10, 11, 500]] = 2
    pos, pen = packing.candidates(classes, np.array([1000]), False)
    assert {10, 11, 12, 501} <= set(pos[pen == packing.AT_SENTENCE].tolist())


def test_chunks_after_a_newline_are_checked_against_the_library():
    import public_tokenizers

    from boardsmith.llm import piece_encoding as P

    a = P.Agenda(public_tokenizers.path("piece_bpe_32k.model"))
    right = a.merge
    a.merge = lambda chunk: right(chunk)[::-1] if chunk in ("zqxj", "qqzz") else right(chunk)  # wrong where no space mark stands in front
    text = "x\nzqxj\tqqzz"
    parts = a.parts(text)
    assert {"zqxj", "qqzz"} <= set(parts)
    [a.chunks[p] for p in parts]
    a.check()
    assert a.disagreed == 2 and ",".join(a.chunks[p] for p in parts) == ",".join(map(str, a.lib.encode(text)))


def test_secrets_in_long_texts_take_linear_time():
    import time

    scan = secret_scan.Scanner()
    end = b"-----END RSA PRIVATE KEY-----"
    head = b"-----BEGIN RSA PRIVATE KEY-----\n"
    for unit in (b"card", b"card ", b"card1", head, b"-----BEGIN " * 2, b"eyJ", b"eyJaaaaaaaaaaa.", b"iban ", b"iban" + b" " * 50, b"token ", b"token=", b"password:  '", b"AKIA", b"ghp_", b"visa 4111 "):
        text = (unit * (200_000 // len(unit) + 1))[:200_000]
        for tail in (b"", end):
            t0 = time.process_time()
            scan.spans(text + tail)
            assert time.process_time() - t0 < 1.0, unit
    kinds = lambda t: [secret_scan.KINDS[k] for _, k, _ in scan.spans(t)]
    block = head + b"MIIE" * 20 + b"\n" + end
    assert kinds(b"a " + block + b" b " + block) == ["pem", "pem"] and scan.spans(b"xx" + block)[0] == (2, secret_scan.KINDS.index("pem"), 2 + len(block))
    assert kinds(head + b"MIIE!" + end) == [] and kinds(head * 3 + b"MIIE" + end) == ["pem"] and kinds(block.replace(b"RSA ", b"")) == ["pem"]
    assert kinds(b"card number: 4111 1111 1111 1111.") == ["card"] and kinds(b"card number: 4111 1111 1111 1112.") == []
    assert "jwt" in kinds(b"x: eyJhbGciOiJI.eyJzdWIiOiIx.abcdefghij") and kinds(b"xeyJhbGciOiJI.eyJzdWIiOiIx.abcdefghij") == []


def test_groups_do_not_grow_through_single_shared_values(spark, monkeypatch):
    """Texts that share common shingles in chains: no group is far above the largest true component, and no link is lost."""
    rng = random.Random(8)
    common = [" ".join(f"c{rng.randrange(40)}" for _ in range(12)) for _ in range(30)]  # phrases that many texts hold
    rows, k = [], 0
    for i in range(300):
        own = " ".join([*rng.sample(common, 4), *(f"u{rng.randrange(10**6)}" for _ in range(30))])
        for _ in range(rng.choice([1, 1, 1, 3])):  # some have near copies
            rows.append((k, own + f" end{rng.randrange(2)}"))
            k += 1
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    seen = []
    real = near_dedup.components

    def spy(links, name):
        out = real(links, name)
        seen.append((name, max([r["count"] for r in out.groupBy("label").count().collect()], default=0)))
        return out

    monkeypatch.setattr(near_dedup, "components", spy)
    got = rows_of(near_dedup.near_duplicates(df, width=3, similarity=(85, 100)), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(brute.near(rows, 3, 85, 100), key=repr)
    largest = dict(seen)
    assert largest["groups"] <= 2 * max(largest["links"], 3)
    monkeypatch.setattr(near_dedup, "LIST_ROWS", 1)  # every list joined whole: the same result
    assert rows_of(near_dedup.near_duplicates(df, width=3, similarity=(85, 100)), "doc_id", "n_shingles", "component_id", "kept") == got


def test_rows_without_ids_or_with_one_id_meet_only_their_own_text(spark):
    texts = [f"{w} " * 3 + " ".join(f"x{i}y{j}" for j in range(30)) for i, w in enumerate(["a", "b"] * 40)]
    for key in (None, 7):
        rows = [(key, t + " tail" * (i % 2)) for i, t in enumerate(texts + texts)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert rows_of(near_dedup.near_duplicates(df), "doc_id", "n_shingles", "component_id", "kept") == sorted(brute.near(rows, 5, 4, 5), key=repr)
