"""Secret scan against Python's own regular expressions and a plain search
for partners."""

import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from lakemarts.llm import credentials, queries
from lakemarts.llm.common import table

SF = "/root/testdata/sf0.01"

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
LOGIN = re.compile(
    r"""(user(?:name)?|login|client_?id|account|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]+)""",
    re.I | re.A,
)
HOST = re.compile(
    r"""(host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.-]+(?::[0-9]+)?)""", re.I | re.A
)
URL = re.compile(
    r"""(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|rediss?|amqps?)://[^\x00-\x20"'<>]+""", re.A
)


def found(text):
    """All candidate spans: ``(kind, start, end, scope)``."""
    breaks = [m.end() for m in re.finditer(r"\n(?:[ \t\r]*\n)+", text)]

    def scope(at):
        return sum(b <= at for b in breaks)

    spans = []
    spans += [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(1, *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(2, *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    spans += [(3, *m.span()) for m in LOGIN.finditer(text) if len(m[2]) >= 3]
    spans += [
        (4, *m.span()) for m in re.finditer(r"[A-Za-z0-9+/_-]{32,}={0,2}", text)
        if all(re.search(c, m[0]) for c in ("[a-z]", "[A-Z]", "[0-9]"))
    ]
    spans += [(5, *m.span()) for m in URL.finditer(text)]
    spans += [(6, *m.span()) for m in HOST.finditer(text) if len(m[2]) >= 4]
    return [(k, s, e, scope(s)) for k, s, e in spans]


def brute(text):
    spans = found(text or "")

    def near(span, kinds, among):
        return any(
            o[0] in kinds and o[3] == span[3] and o[1] - span[2] <= 200 and span[1] - o[2] <= 200 for o in among
        )

    secrets = [s for s in spans if s[0] in (0, 2) or s[0] == 4 and near(s, (1, 3), spans)]
    logins = [s for s in spans if s[0] == 1 or s[0] == 3 and near(s, (0, 2, 4), spans)]
    ends = [s for s in spans if s[0] in (5, 6) and near(s, (0, 2, 4), secrets)]
    names = [k.name for k in credentials.KINDS]
    kept = sorted((s, k, e) for k, s, e, _ in secrets + logins + ends)

    def listed(rows):
        return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in rows)

    base = [r for r in kept if r[1] < 3]
    counts = [sum(r[1] == k for r in kept) for k in range(3)]
    return (*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(kept))


def as_query(docs):
    """The query's columns over a table of its own."""
    spans = credentials.secret_spans(docs)

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind))

    return spans.select("doc_id", *map(count, range(3)), F.sha2("strong_spans", 256), "spans")


HEX = "0123456789abcdef01234567"
WORD = "Ab3" * 12
TEXTS = [
    None, "", "token=a token=abcdefg", "secret=token:abcdefgh", 'Api_Key" : "abc.def=" x', "paſſword=abcdefgh toKen=abcdefgh",
    "AKIA" + "B" * 15 + " AKIA" + "B" * 16 + " AKIAAKIA" + "C" * 14, HEX[:-1] + " " + HEX + "g" + HEX * 2,
    f"login: alice {WORD}", f"{WORD}", "login: alice", f"user=bob\n\n{HEX}", f"user=bob\n{HEX}",
    f"user=bob {'é' * 195}{HEX}", f"user=bob {'é' * 200}{HEX}", f"https://h.example/a?token=abcdefg <b>",
    f"postgres://u@db.example/x {WORD} client_id='me42'", f"host = db.example:5432 password: hunter22",
    f"server=alpha {WORD}", f"{HEX}\r\n \t\n\n server=alpha", "\U0001f600 token = 'ééabcdefg' token:xyz_12",
    "token" * 2000 + "=abcdefgh", "token " * 20_000, ("user=ann " + HEX + " ") * 400,
    "password" + " " * 50_000 + "=abcdefgh",
]


def test_spans_equal_brute_force(ready):
    rnd = random.Random(5)
    bits = [
        "token=", "secret: ", "abcdef1", HEX, WORD, "AKIA" + "Q" * 16, "user=eve", "login:", "http://a.b/c", "host=ab.cd",
        "\n\n", "\n", " \n \n", " ", " und so weiter " * 8, "é\U0001f600", '"', "'", "=", ":",
    ]
    texts = TEXTS + ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))) for _ in range(300)]
    rows = [(None if i == 2 else i // 2, t, 1, "x", "y") for i, t in enumerate(texts)]
    docs = ready.createDataFrame(rows, "doc_id long, text string, row long, kind string, found string").repartition(3)
    got = sorted(map(repr, map(tuple, as_query(docs).collect())))
    assert got == sorted(repr((r[0], *brute(r[1]))) for r in rows)


def test_query_equals_brute_force_and_sql(ready):
    out = queries.op11_secret_scan(ready, SF)
    got = sorted(map(tuple, out.collect()))
    docs = table(ready, SF, "documents").select("doc_id", "text").collect()
    assert got == sorted((r.doc_id, *brute(r.text)) for r in docs)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(con.execute(queries.oracle_sql()["op11_secret_scan"]).fetchall())
    assert any(r[-1] for r in got)


def test_no_python_on_the_main_path(ready, capsys):
    queries.op11_secret_scan(ready, SF).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_edges(edge_docs, no_docs):
    assert as_query(no_docs).collect() == []
    rows = edge_docs.select("doc_id", "text").collect()
    got = sorted(map(repr, map(tuple, as_query(edge_docs).collect())))
    assert got == sorted(repr((r.doc_id, *brute(r.text))) for r in rows)
