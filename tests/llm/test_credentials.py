import hashlib
import re

from tickloom.llm import credentials as cr
from tickloom.llm.queries import QUERIES

KEY = "AbCdEf123456GhIjKl7890xy"


def strong(text):
    spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(cr.ASSIGN, text, re.A) if len(m[2]) >= 8]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans).encode()).hexdigest()


TEXTS = [
    "token = secret: abcdefghijk", "TOKEN='abcdefgh' password==12345678 api_key:x", f"x{'0a' * 16}é AKIA{'B' * 12} AKIAAKIA",
    "é日本 passwd : \"0123456789abcdef0123456789abcdef\"", "akia AKIA1 " + "f" * 31 + "g" + "f" * 33, "", None,
    f"user: bob@x and key {KEY} end https://api.example.com/v1", f"{KEY} alone", f"user: bob\n\n{KEY}",
    f"user: bob\n{KEY}", f"user: bob {'.' * 250} {KEY}", "https://example.com alone", f"AKIA{'Z' * 16} then {KEY}",
    "login=alice token=abcdefgh99 host: db.example.com", "K = tokenK secreſ=abcdefghi",
]


def test_strong_findings_equal_regular_expressions(spark):
    rows = cr.findings(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        spans = strong(TEXTS[r["_id"]] or "")
        assert r["base_sha256"] == digest(spans), (TEXTS[r["_id"]], r["spans"])
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert {f"{k}:{a}:{b}" for a, _, k, b in spans} <= set(r["spans"].split(","))


def test_weak_candidates_need_their_counterparts(spark):
    rows = {r["_id"]: r["spans"] for r in cr.findings(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()}
    assert rows[7] == "identifier:0:11,mixed:20:44,endpoint:49:75"
    assert rows[8] == rows[9] == rows[11] == rows[12] == ""
    assert rows[10] == "identifier:0:9,mixed:10:34"
    assert rows[13] == "access:0:20,mixed:26:50"
    assert rows[14] == "identifier:0:11,assign:12:28,endpoint:29:49"


def test_redaction_keeps_rows_and_the_rest_of_the_text(spark, odd):
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(TEXTS)], "doc_id long, text string, `_text` string")
    rows = {r["doc_id"]: r for r in cr.redact(docs, mask="#").collect()}
    assert len(rows) == len(TEXTS) and rows[6]["text"] is None and rows[0]["_text"] == "k"
    assert rows[7]["text"] == "# and key # end #" and rows[8]["text"] == TEXTS[8]
    assert rows[3]["text"] == 'é日本 #"'
    assert sorted(map(repr, cr.redact(odd).collect())) == sorted(map(repr, odd.collect()))


def test_query_equals_regular_expressions(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op2_credential_links"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["base_sha256"] for r in rows} == {d: digest(strong(t)) for d, t in texts.items()}


def test_odd_rows(odd, nothing):
    rows = cr.findings(odd).collect()
    assert len(rows) == odd.count() and {r["spans"] for r in rows} == {""}
    assert cr.findings(nothing).collect() == [] and cr.redact(nothing).collect() == []
