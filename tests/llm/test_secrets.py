"""Secret scan against Python's regular expressions."""

import hashlib
import re

from weftline.llm import secrets
from weftline.llm.common import table

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX, GENERIC = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+"), re.compile(r"[A-Za-z0-9+/_=-]{20,}")


def base(text):
    found = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text) if len(m[0]) >= 24]


def plain(rows):
    """Spans of each (doc_id, text, source) with the verdict by owners and documents."""
    kinds = ["assign", "access", "hex", "generic"]
    every = []
    for i, text, source in rows:
        text = text or ""
        spans = base(text)
        for m in GENERIC.finditer(text):
            fine = all(re.search(p, m[0]) for p in ("[0-9]", "[A-Z]", "[a-z]"))
            if fine and not any(s < m.end() and m.start() < e for _, s, e, _ in spans if _ is not None):
                every.append((i, source, text, "generic", m.start(), m.end(), m[0]))
        every += [(i, source, text, *s) for s in spans]
    owners, repos = {}, {}
    for i, source, text, _, _, _, v in every:
        owners.setdefault(v, set()).add(source)
        repos.setdefault(v, {}).setdefault(text, set()).add("" if i is None else str(i))
    out = []
    for i, text, source in rows:
        mine = {
            (s, kinds.index(k), e, k, len(owners[v]) <= 1 or len({min(ids) for ids in repos[v].values()}) <= 4)
            for j, src, t, k, s, e, v in every
            if (j, src, t) == (i, source, text or "")
        }
        out.append((i, sorted((s, r, e, k, live) for s, r, e, k, live in mine if k != "generic" or live)))
    return sorted(out, key=repr)


def check(spark, rows, docs=None):
    docs = docs or spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, n_repos int")
    got = [
        (r.doc_id, sorted((s.start, s["rank"], s.end, s.kind, s.live) for s in r.spans or []))
        for r in secrets.secret_scan(docs).collect()
    ]
    assert sorted(got, key=repr) == plain(rows)


KEY = "AKIA" + "ABCDEFGHIJ123456"
LIVE = "aB3" * 8
ROWS = [
    (1, f"é𝒳 token = \"{'ab12' * 6}\" and {KEY}x {LIVE}", "a"),
    (2, f"password: short api_key=token: abcdefgh Api-Key=x SECRET='ABCDEF'{KEY}", "a"),
    (3, f"copied {'0' * 30} everywhere {'Zz9' * 9}", "a"),
    (4, f"copied {'0' * 30} everywhere {'Zz9' * 9}", "b"),
    (5, None, "a"), (6, "", None), (7, "apikey=" + "x" * 50_000 + " " + "deadbeef" * 4000, "c"), (8, LIVE + "\n" + LIVE, None),
    (9, "paſſword=abcdefgh toKen=abcdefgh", "c"), (None, f"token={LIVE}", "d"), (10, "token=abc123 " * 400, "e"), (10, "token=abc123 " * 400, "e"),
    *[(20 + i, f"near copy {i} of {'Qw7' * 9}", "g") for i in range(7)],  # one owner: looks live however often
    *[(30 + i, f"one text, copied {'Er8' * 9}", "gh"[i % 2]) for i in range(8)],  # one repository
    *[(40 + i, f"an example {i} {'Ty9' * 9} and {'0a' * 14}", "gh"[i % 2]) for i in range(6)],  # widely copied
    (11, "tokentoken==abcdef; secret = = x passwd:::abcdefg token: 'a", "e"), (11, "password=abcdef", "e"), (12, "AKIAAKIA" + "A" * 10, "f"),
]


def test_spans_and_verdicts(spark):
    check(spark, ROWS)


def test_what_is_live(spark):
    rows = {r.doc_id: r.spans or [] for r in secrets.secret_scan(spark.createDataFrame(ROWS, "doc_id long, text string, source string")).collect()}
    assert all([(x.kind, x.n_owners, x.n_repos, x.live) for x in rows[20 + i]] == [("generic", 1, 7, True)] for i in range(7))
    assert all([(x.kind, x.n_owners, x.n_repos, x.live) for x in rows[30 + i]] == [("generic", 2, 1, True)] for i in range(8))
    assert all([(x.kind, x.n_owners, x.n_repos, x.live) for x in rows[40 + i]] == [("hex", 2, 6, False)] for i in range(6))


def test_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    check(spark, [(r.doc_id, r.text, r.source) for r in docs.collect()], docs)


def test_query_columns(spark):
    rows = {r.doc_id: r for r in secrets.op9_secret_scan(spark, "/root/testdata/sf0.001").collect()}
    for r in table(spark, "/root/testdata/sf0.001", "documents").collect():
        kinds = ["assign", "access", "hex"]
        found = sorted(base(r.text), key=lambda x: (x[1], kinds.index(x[0])))
        text = ",".join(f"{k}:{s}:{e}" for k, s, e, _ in found)
        got = rows[r.doc_id]
        assert got.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (got.n_assign, got.n_access, got.n_hex) == tuple(sum(x[0] == k for x in found) for k in kinds)
        assert [x for x in got.spans.split(",") if x and not x.startswith("generic")] == [x for x in text.split(",") if x]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert secrets.secret_scan(docs).collect() == []
