"""Secret scan with corpus-wide ownership: DataFrame functions only.

Base kinds, leftmost and non-overlapping, each on its own: `assign`, `access`, `hex`. A further candidate kind, `generic`,
is a run of 20 or more key characters that holds a digit, a capital and a small letter and touches no base span. The value
of each candidate is hashed and counted over the corpus by distinct repositories and distinct owners. A value seen with at
most `max_owners` owners in at most `max_repos` repositories looks live; a value copied more widely is an example. Base
spans always stay; generic ones are added if they look live. `n_live` and `n_example` count candidates by that verdict.

Rules. Null text is empty. Positions are code points, end exclusive. Null repositories count as one repository, null owners
as one owner. Rows are told apart by doc_id and a hash of the text, so rows that repeat both get the same answer, and rows
that share a doc_id with different texts get their own. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.common import table, written

ASSIGN = (
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: Kind -> pattern, what a text must match to be scanned at all, least length, in the order of the kinds.
KINDS = {
    "assign": (ASSIGN, r"""(?i:word|passwd|secret|token|key)["']?\x20*[:=]""", 6),
    "access": (r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]{16}", 20),
    "hex": (r"[0-9a-f]{24,}", r"[0-9a-f]{24}", 24),
    "generic": (r"[A-Za-z0-9+/_=-]{20,}", r"[A-Za-z0-9+/_=-]{20}", 20),
}
_RANK = {kind: i for i, kind in enumerate(KINDS)}


def _hits(text: Column, kind: str) -> Column:
    """Array of (length of the text before it and after the last one, match), in order; null if there is none."""
    pattern, needs, _ = KINDS[kind]
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("found"))
    return F.when(text.rlike(needs), pairs)


def scan(docs: DataFrame, repo: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, _h, _repo, _owner and the raw matches of each kind: one narrow pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        F.xxhash64(text).alias("_h"),
        F.col(repo).cast("string").alias("_repo"),
        F.col(owner).cast("string").alias("_owner"),
        *[_hits(text, kind).alias(kind) for kind in KINDS],
    )


def _candidates(scanned: DataFrame) -> DataFrame:
    """One row per match that counts: kind, position, hash of the value. Rows that repeat a document are one."""
    rows = None
    for kind, (_, _, least) in KINDS.items():
        one = scanned.where(F.col(kind).isNotNull()).select(
            "doc_id", "_h", "_repo", "_owner", F.lit(_RANK[kind]).alias("_rank"), F.posexplode(kind).alias("_i", "_hit")
        )
        found = F.col("_hit.found")
        value = F.regexp_extract(found, ASSIGN, 2) if kind == "assign" else found
        good = F.char_length(value) >= least
        if kind == "generic":
            good &= found.rlike("[0-9]") & found.rlike("[A-Z]") & found.rlike("[a-z]")
        one = one.select(
            "doc_id", "_h", "_repo", "_owner", "_rank", "_i",
            F.col("_hit.gap").alias("_gap"), F.char_length(found).alias("_len"),
            F.when(good, F.sha2(value, 256)).alias("_value"),
        )
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.dropDuplicates(["doc_id", "_h", "_repo", "_owner", "_rank", "_i"])
    along = Window.partitionBy("doc_id", "_h", "_repo", "_owner", "_rank").orderBy("_i")
    end = F.sum(F.col("_gap") + F.col("_len")).over(along)
    placed = rows.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_len"))
    placed = placed.where(F.col("_value").isNotNull())
    # generic runs that touch a base span are dropped: base ends so far, base starts still to come
    doc = Window.partitionBy("doc_id", "_h", "_repo", "_owner").orderBy("_start", "_rank", "_end")
    base = F.col("_rank") < _RANK["generic"]
    ended = F.max(F.when(base, F.col("_end"))).over(doc.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.min(F.when(base, F.col("_start"))).over(doc.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(ended, F.lit(0)) <= F.col("_start")) & (begins.isNull() | (begins >= F.col("_end")))
    return placed.withColumn("_free", base | free).where("_free").drop("_free", "_i", "_gap", "_len")


def ownership(candidates: DataFrame) -> DataFrame:
    """_value, n_repos, n_owners, counted in steps so that a value copied everywhere is summed before it is shuffled.

    Copies of one text are one repository, the first of them: a copy tells nothing of how many have written the value down.
    """
    texts = candidates.groupBy("_value", "_h").agg(F.min("_repo").alias("_first"))
    repos = texts.groupBy("_value", "_first").agg(F.lit(1).alias("_one")).groupBy("_value").agg(F.count(F.lit(1)).alias("n_repos"))
    owners = candidates.groupBy("_value", "_owner").agg(F.lit(1).alias("_one")).groupBy("_value").agg(F.count(F.lit(1)).alias("n_owners"))
    return repos.join(owners, "_value")


def secret_scan(
    docs: DataFrame, *, repo: str = "doc_id", owner: str = "source", max_owners: int = 1, max_repos: int = 4
) -> DataFrame:
    """doc_id, spans (array of kind, start, end, n_repos, n_owners, live): one row per row of docs.

    A value is a widely copied example if it has more than `max_owners` owners and more than `max_repos` repositories; else it looks
    live. So what one owner alone has stays live, however often.
    """
    scanned = written(scan(docs, repo, owner), "secrets-scan")
    found = written(_candidates(scanned), "secrets-found")
    owned = ownership(found)
    live = (F.col("n_owners") <= max_owners) | (F.col("n_repos") <= max_repos)
    judged = found.join(owned, "_value").withColumn("live", live)
    judged = judged.where((F.col("_rank") < _RANK["generic"]) | F.col("live"))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("_rank") + 1)
    span = F.struct(
        F.col("_start").alias("start"), F.col("_rank").alias("rank"), F.col("_end").alias("end"),
        name.alias("kind"), "n_repos", "n_owners", "live",
    )
    per_row = judged.groupBy("doc_id", "_h", "_repo", "_owner").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    keys = ["doc_id", "_h", "_repo", "_owner"]
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    rows = scanned.select(*keys).alias("l").join(per_row.alias("r"), on, "left")
    return rows.select("l.doc_id", F.col("r.spans").alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; each document is a repository, its source the owner."""
    found = secret_scan(table(spark, sf_dir, "documents"))
    none = F.expr("array()").cast(found.schema["spans"].dataType)
    found = found.withColumn("spans", F.coalesce("spans", none))
    base = F.filter("spans", lambda x: x["rank"] < _RANK["generic"])
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda x: ~x["live"])).cast("long").alias("n_example"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def _sql() -> str:
    parts = []
    for kind, (pattern, _, least) in KINDS.items():
        quoted = pattern.replace("'", "''")
        value = f"regexp_extract(m, '{quoted}', 2)" if kind == "assign" else "m"
        good = f"length({value}) >= {least}"
        if kind == "generic":
            good += " AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]')"
        parts.append(f"""
          SELECT doc_id, source, n, {_RANK[kind]} AS kr, '{kind}' AS kind, e - length(m) AS s, e, {value} AS v FROM (
            SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY n ORDER BY i) AS e FROM (
              SELECT doc_id, source, n, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g FROM (
                SELECT doc_id, source, n, regexp_extract_all(t, '{quoted}') AS ms,
                       regexp_split_to_array(t, '{quoted}') AS gs FROM d)))
          WHERE {good}""")
    rows = " UNION ALL ".join(parts)
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id) AS n FROM documents),
a AS ({rows}),
b AS (SELECT a.*, kr < 3 OR NOT EXISTS (
        SELECT 1 FROM a x WHERE x.kr < 3 AND x.doc_id = a.doc_id AND x.s < a.e AND a.s < x.e) AS free FROM a),
c AS (SELECT * FROM b WHERE free),
o AS (
  SELECT v, count(DISTINCT coalesce(source, '')) AS n_owners, count(DISTINCT first) AS n_repos
  FROM (SELECT v, c.source, min(CAST(c.doc_id AS VARCHAR)) OVER (PARTITION BY v, t) AS first FROM c JOIN d USING (n)) GROUP BY v),
j AS (SELECT c.*, n_owners <= 1 OR n_repos <= 4 AS live FROM c JOIN o USING (v)),
k AS (SELECT * FROM j WHERE kr < 3 OR live),
p AS (
  SELECT doc_id, count(*) FILTER (kr = 0) AS n_assign, count(*) FILTER (kr = 1) AS n_access,
         count(*) FILTER (kr = 2) AS n_hex, count(*) FILTER (kr = 3) AS n_generic,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, kr) AS spans,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, kr)
           FILTER (kr < 3) AS base
  FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_generic, 0) AS n_generic, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN p USING (doc_id)
"""


OP9_SQL = _sql()
