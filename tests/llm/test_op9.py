"""Personal data: base spans against a plain reading of the patterns, the method's finds, edge rows."""

import hashlib
import random
import re

from tessera.llm.op9_pii import personal_data
from tests.llm.conftest import documents


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def digits(value):
    return re.sub("[^0-9]", "", value)


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
]


def plain(text):
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(PLAIN) for m in re.finditer(p, text) if ok(m[0])]
    return ",".join(f"{PLAIN[k][0]}:{a}:{b}" for a, k, b in sorted(found))


def test_base_spans_and_edges(spark):
    rng = random.Random(9)
    parts = ["a", "b.c", "@", "x.org", ".", "-", "_", "%", " ", "  ", "1", "255", "256", "001", "4111111111111111", "4111 1111 1111 1111", "+", "(", ")", "+1 (988) 555-2485", "é", "😀", "\n", "10.0.0.1", "9" * 9, "me@a.b"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))) for i in range(3000)]
    rows += [(5000, None), (5001, ""), (5002, "1 " * 30000), (5003, "a" * 60000 + "@"), (5004, "9" * 60000), (5005, "+1" + "(" * 60000), (5006, "a@b.c" * 3000), (None, "me@x.org"), (7, rows[7][1])]
    got = personal_data(documents(spark, rows, ["base", "tokens", "row", "pattern"])).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        want = plain(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), texts[r["doc_id"]][:200]
        kinds = [s.split(":")[0] for s in want.split(",") if s]
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [kinds.count(k) for k in ("email", "ip", "card", "phone")]
        assert set(want.split(",")) <= {*r["spans"].split(","), ""}


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"hello the contact: user{i}@mail.org and the cat") for i in range(12)]
    rows += [(50, "the contact: user-51-at-4477 thanks"), (51, "the 99887766 sheep"), (52, "some contact: nobody"), (53, "see contact: 4111111111111112 ok")]
    got = {r["doc_id"]: r["spans"] for r in personal_data(documents(spark, rows)).collect()}
    assert got[50] == "context:13:28" and got[51] == got[52] == got[53] == "" and got[3].startswith("email:")


def test_no_documents(spark):
    assert personal_data(documents(spark, [])).count() == 0
