"""Secrets in texts, with multipart credentials linked.

Three kinds are reported wherever they stand: assign, access and hex. Three weak kinds are too common to report alone:
key40 (a run of 40 base64 characters), user (an assigned user or client name) and endpoint (a URL). A weak one is
reported only if complementary parts stand within REACH code points of it in the same text: for key40 an identifier
(access or user), for user a secret (assign, hex or key40), and for endpoint both an identifier and a secret.

Spans come from the matches of a pattern and the pieces between them. Only for texts with a weak part and some other
part, the parts are dealt to cells of REACH code points, and an interval semi-join on text and cell finds the linked
ones; it makes no pairs. Texts are keyed by their digest, so copies are linked once.

Very long texts are handled whole, in time in proportion to their length. Null texts are empty ones. Each row has one result row, repeated rows too. Equal starts are ordered by kind. Empty
tables give none; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import settled, table, text_or_empty

REACH = 200
KINDS = ("assign", "access", "hex", "key40", "user", "endpoint")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
USER = r"""((?i:user|username|login|client_?id|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KEY40 = r"[A-Za-z0-9/+]{40,}"
#: A scheme has 31 characters at most, so a long run of letters is looked at a bounded number of times.
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]{0,30}://[^\s"'<>]+"""
#: Lower-case words one of which stands in every match.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
USER_WORDS = ("user", "login", "clientid", "client_id", "account")

SPAN = "array<struct<at:bigint,rank:int,end:bigint>>"


def _has(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def _matches(text: Column, pattern: str, may: Column) -> Column:
    """The matches of a pattern, left to right; null where there can't be any."""
    return F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def _spans(text: Column, hits: Column, pattern: str, kind: str, *, value: int = 0, exactly: int = 0) -> Column:
    """Spans of pattern's matches hits in text; value: the least length of group 2; exactly: a match's only length."""
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(SPAN).alias("out"))

    def step(done: Column, row: Column) -> Column:
        at = done["at"] + F.length(row["gap"])
        end = at + F.length(row["hit"])
        kept = F.length(F.regexp_extract(row["hit"], pattern, 2)) >= value if value else F.length(row["hit"]) == exactly if exactly else F.lit(True)
        own = F.array(F.struct(at.cast("bigint").alias("at"), F.lit(KINDS.index(kind)).alias("rank"), end.cast("bigint").alias("end")))
        return F.struct(F.coalesce(end, at).cast("bigint").alias("at"), F.when(row["hit"].isNotNull() & kept, F.concat(done["out"], own)).otherwise(done["out"]).alias("out"))

    found = F.when(F.size(hits) > 0, F.aggregate(rows, start, step)["out"])
    return F.coalesce(found, F.array().cast(SPAN))


def _of(spans: Column, *kinds: str) -> Column:
    ranks = [KINDS.index(k) for k in kinds]
    return F.filter(spans, lambda s: s["rank"].isin(ranks))


def scanned(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans: an array of (at, rank, end), by start and kind; rank counts KINDS."""
    whole = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text")).withColumn("low", F.lower("text"))
    t, low = F.col("text"), F.col("low")
    kinds = {
        "assign": (ASSIGN, _has(low, ASSIGN_WORDS), {"value": 6}), "access": (ACCESS, F.contains(t, F.lit("AKIA")), {}), "hex": (HEX, F.lit(True), {}),
        "key40": (KEY40, F.lit(True), {"exactly": 40}), "user": (USER, _has(low, USER_WORDS), {}), "endpoint": (ENDPOINT, F.contains(t, F.lit("://")), {}),
    }
    # each pattern passes over a text once, and over the few texts with matches once more
    whole = whole.withColumns({f"m_{k}": _matches(t, p, may) for k, (p, may, _) in kinds.items()})
    spans = {k: _spans(t, F.col(f"m_{k}"), p, k, **options) for k, (p, _, options) in kinds.items()}
    base, weak = F.concat(*(spans[k] for k in KINDS[:3])), F.concat(*(spans[k] for k in KINDS[3:]))
    found = whole.select("doc_id", base.alias("base"), weak.alias("weak"), F.when(F.length("text") > 0, F.sha2("text", 256)).alias("key"))
    found = settled(found.withColumn("key", F.when((F.size("weak") > 0) & (F.size("base") + F.size("weak") > 1), F.col("key"))), "op7")
    alone = found.where("key is null").select("doc_id", F.col("base").alias("spans"))
    several = found.where("key is not null")
    links = linked(several.select("key", "base", "weak").dropDuplicates(["key"]))
    joined = several.join(links, "key", "left").select("doc_id", F.concat("base", F.coalesce("links", F.array().cast(SPAN))).alias("spans"))
    return alone.unionAll(joined).select("doc_id", F.array_sort("spans").alias("spans"))


def linked(texts: DataFrame) -> DataFrame:
    """key and links: the weak spans that complementary parts stand near to."""
    parts = texts.select("key", F.explode(F.concat("base", "weak")).alias("s")).select("key", "s.*")
    weak = parts.where(F.col("rank") >= KINDS.index("key40"))
    near = weak.select("key", "at", "rank", "end", F.explode(F.sequence(F.floor((F.greatest(F.col("at") - REACH, F.lit(0))) / REACH), F.floor((F.col("end") + REACH) / REACH))).alias("cell"))
    cells = parts.select("key", F.col("at").alias("a"), F.col("end").alias("e"), F.col("rank").alias("r"), F.explode(F.sequence(F.floor(F.col("at") / REACH), F.floor(F.col("end") / REACH))).alias("cell"))
    gap = (F.col("a") <= F.col("end") + REACH) & (F.col("e") >= F.col("at") - REACH)
    identifier = cells.where(F.col("r").isin(KINDS.index("access"), KINDS.index("user")))
    secret = cells.where(F.col("r").isin(KINDS.index("assign"), KINDS.index("hex"), KINDS.index("key40")))
    span = ["key", "at", "rank", "end"]
    by_identifier = near.alias("n").join(identifier, (F.col("n.key") == identifier["key"]) & (F.col("n.cell") == identifier["cell"]) & gap, "left_semi").select(*span).distinct()
    by_secret = near.alias("n").join(secret, (F.col("n.key") == secret["key"]) & (F.col("n.cell") == secret["cell"]) & gap, "left_semi").select(*span).distinct()
    marks = by_identifier.withColumn("i", F.lit(1)).withColumn("s", F.lit(0)).unionAll(by_secret.withColumn("i", F.lit(0)).withColumn("s", F.lit(1)))
    both = marks.groupBy(*span).agg(F.max("i").alias("i"), F.max("s").alias("s"))
    key40, user, endpoint = (F.col("rank") == KINDS.index(k) for k in ("key40", "user", "endpoint"))
    complete = both.where((key40 & (F.col("i") == 1)) | (user & (F.col("s") == 1)) | (endpoint & (F.col("i") == 1) & (F.col("s") == 1)))
    return complete.groupBy("key").agg(F.collect_list(F.struct("at", "rank", "end")).alias("links"))


def _written(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["at"].cast("string"), s["end"].cast("string"))), ",")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    found = scanned(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *(F.size(_of(spans, k)).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_written(_of(spans, *KINDS[:3])).cast("binary"), 256).alias("base_sha256"),
        _written(spans).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """text with each span (sorted; overlapping ones together) replaced by the kind it begins with, as [hex]."""
    names = F.array(*(F.lit(k) for k in KINDS))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substr(text, (done["at"] + 1).cast("int"), (s["at"] - done["at"]).cast("int"))
        fresh = F.concat(done["out"], gap, F.lit("["), F.element_at(names, s["rank"] + 1), F.lit("]"))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(s["at"] >= done["at"], fresh).otherwise(done["out"]).alias("out"))

    done = F.aggregate(spans, start, step)
    return F.concat(done["out"], F.substr(text, (done["at"] + 1).cast("int"), F.length(text)))


def _sql_kind(rank: int, pattern: str, keep: str) -> str:
    """DuckDB: the spans of one kind, for every text."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT k, {rank} AS rank, pos AS "at", pos + length(hit) AS e FROM (
    SELECT k, hit, value, sum(length(gap) + length(coalesce(before, ''))) OVER (PARTITION BY k ORDER BY i) AS pos FROM (
      SELECT k, i, gap, hit, value, lag(hit) OVER (PARTITION BY k ORDER BY i) AS before FROM (
        SELECT k, generate_subscripts(h, 1) AS i, unnest(h) AS hit, unnest(v) AS value, unnest(g[:len(h)]) AS gap FROM (
          SELECT k, regexp_extract_all(t, '{p}', 0) AS h, {f"regexp_extract_all(t, '{p}', 2)" if "value" in keep else f"regexp_extract_all(t, '{p}', 0)"} AS v,
                 string_split_regex(t, '{p}') AS g FROM texts WHERE regexp_matches(t, '{p}'))))) WHERE {keep}"""


def _either_case(pattern: str) -> str:
    """The pattern without inline flags, which the oracle reads otherwise."""
    head, _, tail = pattern.partition(r"""["']?\x20*[:=]""")
    if not tail:
        return pattern
    words = head.removeprefix("((?i:").removesuffix("))")
    return "(" + "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words) + ")" + r"""["']?\x20*[:=]""" + tail


OP7_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
parts AS MATERIALIZED ({" UNION ALL ".join(_sql_kind(i, _either_case(p), keep) for i, (p, keep) in enumerate([(ASSIGN, "length(value) >= 6"), (ACCESS, "true"), (HEX, "true"), (KEY40, "length(hit) = 40"), (USER, "true"), (ENDPOINT, "true")]))}),
near AS (
  SELECT w.k, w.rank, w."at", w.e,
         bool_or(p.rank IN (1, 4)) AS i, bool_or(p.rank IN (0, 2, 3)) AS s
  FROM parts w JOIN parts p ON w.k = p.k AND p."at" <= w.e + {REACH} AND p.e >= w."at" - {REACH} WHERE w.rank >= 3 GROUP BY ALL),
spans AS (
  SELECT k, rank, "at", e FROM parts WHERE rank < 3
  UNION ALL SELECT k, rank, "at", e FROM near WHERE (rank = 3 AND i) OR (rank = 4 AND s) OR (rank = 5 AND i AND s)),
named AS (SELECT *, ['{"', '".join(KINDS)}'][rank + 1] || ':' || "at"::BIGINT || ':' || e::BIGINT AS word FROM spans)
SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
       sha256(coalesce(string_agg(word, ',' ORDER BY "at", rank) FILTER (rank < 3), '')) AS base_sha256,
       coalesce(string_agg(word, ',' ORDER BY "at", rank, e), '') AS spans
FROM texts LEFT JOIN named USING (k) GROUP BY texts.k, doc_id
"""
