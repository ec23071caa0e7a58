"""Secrets in documents, with multipart credentials linked by interval joins.

Method: strong findings (assignments, access keys, long hexadecimal strings) are reported as
they are. Weak candidates (identifiers, mixed tokens, endpoints) are reported only where
complementary parts co-occur: in the same scope (document and section between blank lines)
and at most `reach` characters apart, an identifier needs a secret, a secret needs an
identifier, and an endpoint needs both. Strong findings count as parts. Candidates are joined
on document, scope and character bin with an interval condition, as semi-joins, so that no
pairs come out.

Only DataFrame functions are used. Positions come from the pieces that a pattern splits the
text into: running sums of their lengths along a document. Texts are scanned once; the stored
findings are small.

Defined cases: a null text is empty; documents are told apart by id (null allowed) and text,
so repeated rows get the same result; a text without findings has empty lists; further
columns are ignored by `findings` and kept by `redact`. Positions are code points, ends
exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import parted, row_key, stored

# Fixed patterns: (kind, pattern, group whose length counts, least length). The first three
# are the strong ones, in the order of the digest.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
STRONG = [("assign", ASSIGN, 2, 8), ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]{32,}+", 0, 32)]
IDENTIFIER = (r"""(?i:\b(?:access_?key_?id|client_?id|account_?id|user_?name|user|login))["']?\x20*[:=]\x20*["']?"""
              r"""([A-Za-z0-9@._+-]+)""")
MIXED = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+={0,2}"
ENDPOINT = (r"""(?i:https?://[A-Za-z0-9.-]++(?::[0-9]++)?(?:/[A-Za-z0-9._~/?&=%-]*+)?"""
            r"""|\b(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:/_-]++)""")
WEAK = [("identifier", IDENTIFIER, 1, 3), ("mixed", MIXED, 0, 20), ("endpoint", ENDPOINT, 0, 8)]
BREAK = ("break", r"\n[\x20\t\r]*+\n", 0, 2)
RANK = {name: i for i, (name, *_) in enumerate([*STRONG, *WEAK, BREAK])}
IDENTIFIERS, SECRETS = ("identifier", "access"), ("mixed", "assign", "hex")
REACH = 200
KEY = ["_id", "_text"]


def _matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """All matches in order: length of what lies before, own length, and whether it counts."""
    p = F.lit(pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    part = whole if group == 0 else F.regexp_extract_all(text, p, F.lit(group))
    before = F.split(text, pattern, -1)
    found = F.transform(F.arrays_zip(whole.alias("whole"), part.alias("part"), before.alias("before")), lambda x, i: F.struct(
        F.lit(RANK[kind]).alias("rank"), i.alias("no"), F.length(x["before"]).alias("before"),
        F.length(x["whole"]).alias("length"), (F.length(x["part"]) >= least).alias("counts")))
    return F.when(F.regexp_like(text, p), F.filter(found, lambda x: x["length"].isNotNull()))


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored candidates of all kinds: key, rank, start and end."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = F.filter(F.array(*[_matches(text, *k) for k in [*STRONG, *WEAK, BREAK]]), lambda x: x.isNotNull())
    rows = docs.select(*row_key(id_col, text_col), F.explode(F.flatten(kinds)).alias("x")).select(*KEY, "x.*").dropDuplicates(
        [*KEY, "rank", "no"])
    along = Window.partitionBy(*KEY, "rank").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("before") + F.col("length")).over(along)
    return stored(rows.withColumn("end", end).filter("counts").select(
        *KEY, "rank", (F.col("end") - F.col("length")).alias("start"), "end"))


def link(candidates: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak candidates that are reported: key, rank, start and end."""
    weak = [RANK[k] for k, *_ in WEAK]
    # A document without any weak candidate needs no scopes.
    scoped = Window.partitionBy(*KEY).orderBy("start", F.desc("rank")).rowsBetween(Window.unboundedPreceding, 0)
    placed = candidates.withColumns({
        "weak": F.max(F.col("rank").isin(weak)).over(Window.partitionBy(*KEY)),
        "scope": F.sum((F.col("rank") == RANK["break"]).cast("int")).over(scoped)})
    parts = stored(placed.filter(F.col("weak") & (F.col("rank") != RANK["break"])).drop("weak"))

    def near(left: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
        """Rows of `left` that have a part of one of the kinds within reach."""
        spread = F.explode(F.sequence(F.expr(f"(start - {reach}) div {reach}"), F.expr(f"(end + {reach}) div {reach}")))
        here = left.withColumn("bin", spread).alias("l")
        there = parts.filter(F.col("rank").isin([RANK[k] for k in kinds])).withColumn(
            "bin", F.explode(F.sequence(F.expr(f"start div {reach}"), F.expr(f"end div {reach}")))).alias("r")
        same = [F.col("l._id").eqNullSafe(F.col("r._id")), *[F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("_text", "scope", "bin")]]
        apart = (F.col("l.start") - F.col("r.end") <= reach) & (F.col("r.start") - F.col("l.end") <= reach)
        on = same[0]
        for c in [*same[1:], apart]:
            on = on & c
        return here.join(there, on, "left_semi").drop("bin").distinct()

    def of(kind: str) -> DataFrame:
        return parts.filter(F.col("rank") == RANK[kind])

    strong = parts.filter(F.col("rank") < len(STRONG)).alias("r")
    fresh = of("mixed").alias("l").join(
        strong, F.col("l._id").eqNullSafe(F.col("r._id")) & (F.col("l._text") == F.col("r._text"))
        & (F.col("l.start") < F.col("r.end")) & (F.col("r.start") < F.col("l.end")), "left_anti")
    reported = near(of("identifier"), SECRETS).unionByName(near(fresh, IDENTIFIERS)).unionByName(
        near(near(of("endpoint"), SECRETS), IDENTIFIERS))
    return reported.select(*KEY, "rank", "start", "end")


def reported(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Strong findings and linked weak ones: key, rank, start and end."""
    candidates = scan(docs, id_col, text_col)
    base = candidates.filter(F.col("rank") < len(STRONG))
    return base.unionByName(link(candidates, reach))


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """The key and the findings of every row: counts and digest of the strong ones, and all as text."""
    names = F.array(*[F.lit(k) for k in RANK])
    spans = reported(docs, id_col, text_col, reach).groupBy(*KEY).agg(
        F.sort_array(F.collect_set(F.struct("start", "rank", "end"))).alias("spans"))
    every = docs.select(*row_key(id_col, text_col)).alias("e")
    spans = spans.alias("s")
    rows = every.join(spans, F.col("e._id").eqNullSafe(F.col("s._id")) & (F.col("e._text") == F.col("s._text")), "left").select(
        "e._id", "e._text", F.coalesce("spans", F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")).alias("spans"))

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", F.element_at(names, x["rank"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["rank"] == RANK[kind])).cast("long").alias(f"n_{kind}")

    return rows.select(*KEY, *[count(k) for k, *_ in STRONG],
                       F.sha2(written(F.filter("spans", lambda x: x["rank"] < len(STRONG))), 256).alias("base_sha256"),
                       written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[credential]",
           reach: int = REACH) -> DataFrame:
    """The rows with every finding in the text replaced by `mask`; other columns stay."""
    # Findings that overlap are one; a finding starts a new one if all before it have ended.
    before = Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    spans = reported(docs, id_col, text_col, reach).withColumn("fresh", F.coalesce(
        F.col("start") >= F.max("end").over(before), F.lit(True)))
    spans = spans.withColumn("run", F.sum(F.col("fresh").cast("int")).over(upto)).groupBy(*KEY, "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    # What stays: from the end of one to the start of the next, and the rest of the text.
    along = Window.partitionBy(*KEY).orderBy("start")
    kept = stored(spans.withColumn("from", F.coalesce(F.lag("end").over(along), F.lit(0))).groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("from", "start", "end"))).alias("gaps")))
    # Rows without a finding stay where they are.
    rows, clear = parted(docs, row_key(id_col, text_col), kept, [F.col(c) for c in KEY])
    rows = rows.select(*row_key(id_col, text_col), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).alias("d")
    joined = rows.join(kept.alias("s"), F.col("d._id").eqNullSafe(F.col("s._id")) & (F.col("d._text") == F.col("s._text")), "left")
    text = F.col("row")[text_col]

    def piece(g: Column) -> Column:
        return F.substring(text, (g["from"] + 1).cast("int"), (g["start"] - g["from"]).cast("int"))

    rest = F.substring(text, (F.element_at("gaps", -1)["end"] + 1).cast("int"), F.length(text))
    clean = F.when(F.col("gaps").isNull(), text).otherwise(F.concat(
        F.array_join(F.transform("gaps", piece), mask), F.lit(mask), rest))
    return joined.select(*[(clean if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns]).union(clear)
