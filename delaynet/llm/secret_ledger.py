"""Secret scans over an incremental ledger of content-addressed texts.

Every version of a document is a text at a path. A text's address is its SHA-256, so
versions with equal texts are one blob. The ledger is a Parquet table with one row for
each pair of blob and rule version that was ever scanned, together with what was found:
    blob binary, rule string, spans array<struct<begin int, end int>>
A scan looks up which pairs the ledger lacks, reads the text of one version of each blob
that is due, appends the new pairs, and joins the findings back to all paths. A pair and
its findings are written in one row, so a job that dies leaves no pair half done.

Everything here is DataFrame expressions. A rule's matches are found by cutting the text
at them: the lengths of the pieces between matches and of the matches, summed up in
order, are the places of the matches in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delaynet.session import materialize

LEDGER = "blob binary, rule string, spans array<struct<begin:int,end:int>>"
SMALL_ROWS = 500_000  # a join side of at most so many addresses (under 100 MB) is broadcast
HOT_COPIES = 100_000  # copies of one blob from which its paths are salted


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern` whose group `part` has at least `least` characters."""

    kind: str
    pattern: str
    part: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        """What the ledger knows the rule by; a changed pattern needs a new version."""
        return f"{self.kind}@{self.version}"


# Patterns and least lengths are fixed values. A run of one character class is one match whatever its length, so
# asking for the least length in the pattern drops the same matches as looking at it afterwards, without a match at
# every short run. The value of an assignment may hold a further keyword, so there the length is looked at afterwards.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)


def address(text: Column) -> Column:
    """The content address of a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All rows of the ledger; none if it was never written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.range(0).select(F.from_json(F.lit(None).cast("string"), LEDGER).alias("row")).select("row.*")
    return spark.read.schema(LEDGER).parquet(ledger)


def _small(rows: DataFrame, most: int) -> DataFrame:
    """`rows`, marked for broadcast if they are few by count."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def _marks(text: Column, rule: Rule) -> Column:
    """Lengths of gap, match and part for each match of a rule in a text, in order; empty if there is none."""
    pattern = F.lit(rule.pattern)
    pieces = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, pattern, F.lit(rule.part)).alias("part"),
    )
    lengths = F.transform(
        F.filter(pieces, lambda x: x["hit"].isNotNull()),
        lambda x: F.struct(*[F.char_length(x[name]).alias(name) for name in ("gap", "hit", "part")]),
    )
    return F.when(text.rlike(rule.pattern), lengths).otherwise(F.array().cast("array<struct<gap:int,hit:int,part:int>>"))


def find(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for `blob, text, due`: one for each blob and each rule name in `due`.

    Blobs must be distinct. Texts stay in their tasks; what moves is the lengths of
    matches, by blob, and no blob brings more of them than its text holds.
    """
    scans = F.array(*[
        F.when(F.array_contains("due", rule.name), F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.least).alias("least"), _marks(F.col("text"), rule).alias("marks")))
        for rule in rules
    ])
    scanned = texts.select("blob", F.explode(scans).alias("scan")).filter("scan is not null")
    marks = scanned.select("blob", "scan.rule", "scan.least", F.posexplode_outer("scan.marks").alias("at", "mark"))
    before = Window.partitionBy("blob", "rule").orderBy("at")
    end = F.sum(F.col("mark.gap") + F.col("mark.hit")).over(before).cast("int")
    span = F.when(F.col("mark.part") >= F.col("least"), F.struct((end - F.col("mark.hit")).alias("begin"), end.alias("end")))
    placed = marks.repartition(F.col("blob")).select("blob", "rule", span.alias("span"))
    return placed.groupBy("blob", "rule").agg(F.array_sort(F.collect_list("span")).alias("spans"))


def scan(
    versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text", paths: tuple[str, ...] = ("doc_id",),
    small_rows: int = SMALL_ROWS, hot_copies: int = HOT_COPIES,
) -> DataFrame:
    """`paths, blob, spans` for every version, after scanning what the ledger lacks.

    `spans` is an array of `begin, nth, end, kind` by begin and place of the rule in
    `rules`; places are code points, the end is exclusive. A null text is an empty one and
    has no spans. Rows with equal paths each give a row, copies of a text are scanned
    once whatever their number, and whole texts of any length are scanned. No versions
    give no rows and leave the ledger as it was. Other columns are not read.
    """
    spark = versions.sparkSession
    texts = versions.select(address(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    headers = materialize(versions.select(*[F.col(name).alias(f"path{n}") for n, name in enumerate(paths)], address(F.col(text)).alias("blob")), "headers")
    copies = materialize(headers.groupBy("blob").agg(F.count("*").alias("copies")), "blobs")
    known = read_ledger(spark, ledger).select("blob", "rule")
    names = F.array(*[F.lit(rule.name) for rule in rules])
    if known.isEmpty():
        # Every blob is due: only those with copies have to meet.
        repeated = copies.filter("copies > 1")
        due = texts.join(_small(repeated, small_rows), "blob", "left").withColumn("due", names)
    else:
        pairs = copies.select("blob", "copies", F.explode(names).alias("rule")).join(known, ["blob", "rule"], "left_anti")
        unseen = materialize(pairs.groupBy("blob", "copies").agg(F.collect_set("rule").alias("due")), "unseen")
        due = texts.join(_small(unseen, small_rows), "blob")
    alone = due.filter("copies is null or copies = 1")
    once = due.filter("copies > 1").dropDuplicates(["blob"])
    new = find(alone.select("blob", "text", "due").unionByName(once.select("blob", "text", "due")), rules)
    new.write.mode("append").parquet(ledger)

    found = read_ledger(spark, ledger).filter(F.size("spans") > 0).join(copies, "blob", "left_semi").dropDuplicates(["blob", "rule"])
    kinds = F.create_map(*[F.lit(x) for nth, rule in enumerate(rules) for x in (rule.name, nth)])
    listed = found.filter(F.col("rule").isin([rule.name for rule in rules])).select("blob", F.explode("spans").alias("span"), kinds[F.col("rule")].alias("nth"))
    span = F.struct("span.begin", "nth", "span.end", F.array(*[F.lit(rule.kind) for rule in rules])[F.col("nth")].alias("kind"))
    dirty = materialize(listed.groupBy("blob").agg(F.array_sort(F.collect_list(span)).alias("spans")), "findings")
    joined = _join_back(headers, dirty, copies, small_rows, hot_copies)
    spans = F.coalesce("spans", F.array().cast(joined.schema["spans"].dataType))
    return joined.select(*[F.col(f"path{n}").alias(name) for n, name in enumerate(paths)], "blob", spans.alias("spans"))


def _join_back(headers: DataFrame, dirty: DataFrame, copies: DataFrame, small_rows: int, hot_copies: int) -> DataFrame:
    """Findings at every path. Few findings are broadcast; otherwise the paths of a blob with many copies are salted.

    At most rows / hot_copies blobs are hot, which bounds the table that names them.
    """
    if dirty.limit(small_rows + 1).count() <= small_rows:
        return headers.join(F.broadcast(dirty), "blob", "left")
    hot = F.broadcast(materialize(copies.filter(F.col("copies") > hot_copies).select("blob", F.ceil(F.col("copies") / hot_copies).cast("int").alias("salts")), "hot"))
    salts = F.coalesce("salts", F.lit(1))
    dealt = headers.join(hot, "blob", "left").withColumn("salt", F.pmod(F.xxhash64(*headers.columns, F.monotonically_increasing_id()), salts).cast("int"))
    spread = dirty.join(hot, "blob", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.drop("salts").join(spread.drop("salts"), ["blob", "salt"], "left").drop("salt")


def summary(scanned: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id") -> DataFrame:
    """Counts by kind, the digest of the spans and the spans as text, for each row of `scan`."""
    line = F.concat_ws(",", F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["begin"].cast("string"), x["end"].cast("string"))))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return scanned.select(doc_id, *[count(rule.kind) for rule in rules], F.sha2(line.cast("binary"), 256).alias("base_sha256"), line.alias("spans"))


# The same rows from `documents`, for the rules above.
SUMMARY_SQL = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
rules(kind, nth, pattern, part, least) AS (VALUES
    ('assign', 0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    ('access', 1, '(AKIA[A-Z0-9]+)', 1, 20),
    ('hex', 2, '([0-9a-f]{24,})', 1, 24)),
cut AS (
    SELECT r, kind, nth, least,
        CASE nth WHEN 0 THEN regexp_extract_all(t, (SELECT pattern FROM rules WHERE nth = 0), 0)
                 WHEN 1 THEN regexp_extract_all(t, (SELECT pattern FROM rules WHERE nth = 1), 0)
                 ELSE regexp_extract_all(t, (SELECT pattern FROM rules WHERE nth = 2), 0) END AS hits,
        CASE nth WHEN 0 THEN regexp_extract_all(t, (SELECT pattern FROM rules WHERE nth = 0), 2)
                 WHEN 1 THEN regexp_extract_all(t, (SELECT pattern FROM rules WHERE nth = 1), 1)
                 ELSE regexp_extract_all(t, (SELECT pattern FROM rules WHERE nth = 2), 1) END AS parts,
        string_split_regex(t, pattern) AS gaps
    FROM texts CROSS JOIN rules),
placed AS (
    SELECT r, kind, nth, least, length(parts[i]) AS part, length(hits[i]) AS size,
        length(array_to_string(gaps[1:i], '')) + length(array_to_string(hits[1:i - 1], '')) AS start
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM cut)),
spans AS (
    SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, nth) AS line
    FROM placed WHERE part >= least GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(line, '')) AS base_sha256, coalesce(line, '') AS spans
FROM texts LEFT JOIN spans USING (r)
"""
