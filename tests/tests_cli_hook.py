"""A reply hook importable by Python workers (used by test_cli)."""

import re


def reply(batch_id, prompt):
    out = []
    for m in re.finditer(r"(?m)^([0-9]+)\. Title: (.*?), Contents: ", prompt):
        out.append(f"{m.group(1)}. post {m.group(2)}\n댓글: 없음\n키워드:\n- {m.group(2)}\n- forum\n- post\n성향: 질문성")
    return "\n\n".join(out)
