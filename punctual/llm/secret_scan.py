"""Secret scans over an incremental blob ledger.

Every historical version of every path is addressed by the SHA-256 of its
text. A ledger table says which (blob, rule@version) pairs have been scanned
and what was found; a run scans only the pairs the ledger lacks, each blob once
however many paths or versions hold it, appends them, and joins the findings
back to all paths. Only DataFrame functions are used.

A rule is a kind, a pattern, the group whose length counts, the least length
and a version; a changed version makes the rule unseen for every blob. Matches
of a rule are leftmost and do not overlap, including those then dropped for
their length. Spans are in code points, the end exclusive. Patterns are written
so that the matcher neither recurses nor tries a stretch again and again: they
take time in proportion to the text, near misses of a megabyte too. A web token
is looked for where a run of its characters and dots begins.

Defined results: a null text is the empty text; an empty text has no finding
and is still in the ledger; a null path is a path like any other; repeated rows
give repeated rows; spans that begin together are listed in rule order; columns
other than the keys and the text are not read by ``scan``; the table may be
empty. Texts of any length are scanned whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import let, materialize, sheltered
from punctual.session import scratch_path


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    gate: str          # a cheap pattern that any match contains
    group: int = 0
    least: int = 1
    version: int = 1
    inner: str = ""    # what a match must begin with, which is then the span

    @property
    def plain(self) -> str:
        """The pattern without possessive marks, for engines that never go back."""
        return self.pattern.replace("*+", "*").replace("++", "+")

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api")) + "_?" + either_case("key")

#: a private key: header and footer with what lies between them, in which no two
#: dashes follow each other; the header alone where no footer follows. Each place
#: can be matched in one way only, so nothing is tried twice
_BEGIN, _END = (rf"-----{w} [A-Z0-9 ]*PRIVATE KEY-----" for w in ("BEGIN", "END"))
_TOKEN = "[A-Za-z0-9_-]"

#: in the order in which spans that begin together are listed
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", rf"""(?:{_NAMES})["']?\x20*[:=]""", group=2, least=8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", r"AKIA[A-Z0-9]{12}"),
    Rule("hex", r"[0-9a-f]{32,}", r"[0-9a-f]{32}"),
    Rule("pem", _BEGIN + r"(?:[^-]*+(?:-[^-]++)*+" + _END + ")?", r"-----BEGIN ", version=3),
    Rule("jwt", r"\beyJ[A-Za-z0-9_.-]+", r"eyJ[A-Za-z0-9_-]{8}", version=3,
         inner=rf"^eyJ{_TOKEN}{{8,}}\.eyJ{_TOKEN}{{8,}}\.{_TOKEN}+"),
)

BLOCK = 128  # matches added up together

SPAN = "array<struct<start:int,rank:int,end:int,kind:string,rule:string>>"


def find(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule: what lies between the matches gives their places."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    if rule.inner:
        part = F.transform(whole, lambda w: F.regexp_extract(w, rule.inner, 0))
    parts = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("whole"), part.alias("part"))

    def add(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["gap"])
        end = start + F.coalesce(F.length(p["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(p["part"]) if rule.inner else end).alias("end"),
                        F.lit(rule.kind).alias("kind"), F.lit(rule.id).alias("rule"))
        good = F.length(p["part"]) >= rule.least
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"))

    def shift(s: Column, by: Column) -> Column:
        return F.struct((s["start"] + by).alias("start"), s["rank"], (s["end"] + by).alias("end"), s["kind"], s["rule"])

    def places(ps: Column) -> Column:
        # an array that grows by one is copied each time, so matches are added
        # up in blocks, and the blocks by where they begin
        first = F.sequence(F.lit(0), F.floor((F.size(ps) - 1) / F.lit(BLOCK)).cast("int"))
        blocks = F.transform(first, lambda b: F.aggregate(F.slice(ps, b * BLOCK + 1, F.lit(BLOCK)), F.struct(F.lit(0).alias("at"), none.alias("found")), add))
        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("found")), lambda acc, b: F.struct(
            (acc["at"] + b["at"]).alias("at"), F.concat(acc["found"], F.array(F.transform(b["found"], lambda s: shift(s, acc["at"])).cast(SPAN))).alias("found")),
            lambda acc: F.flatten(acc["found"]))

    none = F.array().cast(SPAN)
    return F.when(text.rlike(rule.gate), let(parts, places)).otherwise(none)


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def scan(spark: SparkSession, versions: DataFrame, keys: list[str], ledger: str, text: str = "text",
         rules: tuple[Rule, ...] = RULES, salt: int = 16) -> DataFrame:
    """Bring the ledger (a Parquet folder, made if absent) up to date and return
    ``keys``, ``blob_id`` and ``spans`` (sorted by start, then rule order) for
    every row of ``versions``."""
    rows = versions.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(text).alias("_text"))
    names = [f"_k{i}" for i in range(len(keys))]
    rows = rows.withColumn("_blob", address(F.col("_text")))
    index = materialize(spark, rows.select(*names, "_blob"), "blobs")

    # one place of each blob, without those whose rules the ledger has all
    wanted = F.array(*[F.lit(r.id) for r in rules])
    todo = index.groupBy("_blob").agg(F.min(F.struct(*names)).alias("_at"))
    if (known := read_ledger(spark, ledger)) is not None:
        seen = known.groupBy(F.col("blob_id").alias("_blob")).agg(F.flatten(F.collect_list("rules")).alias("_seen"))
        todo = todo.join(seen, "_blob", "left")
        todo = todo.withColumn("_todo", F.array_except(wanted, F.coalesce("_seen", F.array().cast("array<string>"))))
        todo = todo.where(F.size("_todo") > 0)
    else:
        todo = todo.withColumn("_todo", wanted)
    todo = todo.select(F.col("_blob").alias("_b"), *[F.col(f"_at.{n}").alias(f"_r{n}") for n in names], "_todo")

    same = F.col("_blob") == F.col("_b")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_r{n}"))
    found = [F.when(F.array_contains("_todo", r.id), find(F.coalesce("_text", F.lit("")), r, i)).otherwise(F.array().cast(SPAN))
             for i, r in enumerate(rules)]
    new = (rows.join(todo.hint("shuffle_hash"), same)
           .select(F.col("_blob").alias("blob_id"), F.col("_todo").alias("rules"), F.concat(*found).alias("spans"))
           .dropDuplicates(["blob_id"]))  # rows repeated with the same keys
    new.write.mode("append").parquet(ledger)

    current = F.filter("s", lambda s: F.array_contains(wanted, s["rule"]))
    findings = (read_ledger(spark, ledger).where(F.size("spans") > 0)
                .groupBy(F.col("blob_id").alias("_b")).agg(F.flatten(F.collect_list("spans")).alias("s"))
                .select("_b", F.sort_array(F.array_distinct(current)).alias("spans"))
                .withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))))
    # a blob may be held by very many paths: its rows go to `salt` places
    spread = F.pmod(F.xxhash64(*names), F.lit(salt)).cast("int")
    return (index.withColumn("_salt", spread)
            .join(findings, (F.col("_blob") == F.col("_b")) & (F.col("_salt") == F.col("_s")), "left")
            .select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], F.col("_blob").alias("blob_id"),
                    F.coalesce("spans", F.array().cast(SPAN)).alias("spans")))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger's rows, or None where there is no ledger yet."""
    try:
        return spark.read.schema(f"blob_id string, rules array<string>, spans {SPAN}").parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(spark: SparkSession, docs: DataFrame, ledger: str) -> DataFrame:
    """Counts and digests of the findings of each document."""
    base = ("assign", "access", "hex")
    out = scan(spark, docs, ["doc_id"], ledger)

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    return out.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(*base))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def cut_out(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every maximal run of overlapping spans replaced by ``mark``."""
    def add(acc, s):
        fresh = s["start"] >= acc["at"]
        head = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, head).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(spans, zero, add, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


@sheltered
def redact(spark: SparkSession, docs: DataFrame, ledger: str, text: str = "text", mark: str = "[secret]", salt: int = 16) -> DataFrame:
    """All rows and columns of ``docs``; the secrets in the text are replaced,
    and ``n_chars``, where there is one, counts the new text. A null text stays null."""
    own = {"__blob": address(F.col(text)), "__salt": F.pmod(F.xxhash64(*[docs[c] for c in docs.columns if c != text], F.lit(0)), F.lit(salt)).cast("int")}
    rows = docs.withColumns(own)
    found = (scan(spark, rows.select("__blob", F.col(text).alias("__text")), ["__blob"], ledger, text="__text")
             .where(F.size("spans") > 0).groupBy(F.col("__blob").alias("__id")).agg(F.first("spans").alias("__spans"))
             .withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))))
    clean = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(cut_out(F.col(text), F.col("__spans"), mark))
    out = rows.join(found.hint("shuffle_hash"), (F.col("__blob") == F.col("__id")) & (F.col("__salt") == F.col("__copy")), "left")
    changed = {text: clean}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length(clean).cast(dict(docs.dtypes)["n_chars"]))
    return out.withColumns(changed).select(*docs.columns)


def new_ledger(spark: SparkSession) -> str:
    return scratch_path(spark, "llm-ledger")


def _oracle() -> str:
    def spans(rank: int, r: Rule) -> str:
        p = r.plain.replace("'", "''")
        part = f"regexp_extract(m[i], '{r.inner}')" if r.inner else "g[i]"
        return f"""
    SELECT doc_id, {rank} AS rank, '{r.kind}' AS kind, length({part if r.inner else "m[i]"}) AS n, length({part}) AS counted,
           coalesce(list_sum(list_transform(gap[1:i], lambda x: length(x))), 0)
           + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT doc_id, m, g, gap, unnest(range(1, len(m) + 1)) AS i
          FROM (SELECT doc_id, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {r.group}) AS g,
                       string_split_regex(t, '{p}') AS gap FROM d))
    WHERE length({part}) >= {r.least}"""

    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({' UNION ALL '.join(spans(i, r) for i, r in enumerate(RULES))}),
s AS (SELECT doc_id, kind, rank, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT) AS span FROM f),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(span, ',' ORDER BY start, rank) FILTER (kind IN ('assign', 'access', 'hex')) AS base,
             string_agg(span, ',' ORDER BY start, rank) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)"""


ORACLE = _oracle()
