"""Tables of a data folder and the views the queries share, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.hashing import pick, uniform
from ticketloom.functions.text import clean_text
from ticketloom.session import settle

CLASSES = ["click", "error", "purchase", "signup", "view"]
LANGS = ["de", "en", "es", "fr"]
RATERS = ["author", "r1", "r2", "r3"]
SLICES = ["english", "mixed", "short"]
KINDS = ["email", "upi", "pan", "ifsc", "mobile", "fragment", "multi", "none"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The same table as a file stream, whether it is one file or a folder of files."""
    reader, where = spark.readStream.schema(table(spark, sf, name).schema), spark._jvm.org.apache.hadoop.fs.Path(f"{sf}/{name}.parquet")
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        return reader.parquet(f"{sf}/{name}.parquet")
    # a file stream watches a folder, here for one name
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def balanced(df: DataFrame) -> DataFrame:
    """Spread a scan over the partitions that ``spark.ticketloom.scanPartitions`` asks for.

    Unset, as on a cluster, nothing is shuffled: the split size of the reader rules. Local
    sessions set it, since their tables lie in one unsplittable file each.
    """
    wanted = df.sparkSession.conf.get("spark.ticketloom.scanPartitions", None)
    return df.repartition(int(wanted)) if wanted else df


def r6(column: Column | str) -> Column:
    return F.round(column, 6)


def u_sql(salt: str, key: str) -> str:
    return f"(CAST('0x' || substr(md5('{salt}|' || {key}), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"


def pick_sql(choices: list[str], u: str) -> str:
    listed = ", ".join(f"'{c}'" for c in choices)
    return f"([{listed}])[1 + CAST(floor({u} * {float(len(choices))}) AS INT)]"


# --- predictions: events with a simulated pair of classifiers -------------------------


def pred(spark: SparkSession, sf: str) -> DataFrame:
    return pred_of(table(spark, sf, "events"))


def pred_of(events: DataFrame) -> DataFrame:
    """On the events table or on a stream of it."""

    def guess(salt: str, p: float) -> Column:
        wrong = pick(CLASSES, uniform(f"{salt}2", "event_id"))
        return F.when(uniform(salt, "event_id") < F.lit(p), F.col("event_type")).otherwise(wrong)

    def sure(salt: str, right: Column) -> Column:
        u = uniform(salt, "event_id")
        return F.when(right, F.lit(0.35) + F.lit(0.65) * F.sqrt(u)).otherwise(F.lit(0.25) + F.lit(0.70) * u)

    rows = events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("y"),
        guess("a", 0.85).alias("a"),
        guess("b", 0.80).alias("b"),
        F.get_json_object("props", "$.k").cast("int").alias("intent"),
        F.element_at(F.array(*[F.lit(s) for s in SLICES]), (F.col("user_id") % 3 + 1).cast("int")).alias("slice"),
        "ts",
        "value",
        "event_id",
    )
    return rows.withColumns(
        {
            "confidence": sure("c", F.col("a") == F.col("y")),
            "confidence_b": sure("cb", F.col("b") == F.col("y")),
        }
    ).drop("event_id")


def _guess_sql(salt: str, p: float) -> str:
    wrong = pick_sql(CLASSES, u_sql(salt + "2", "event_id"))
    return f"CASE WHEN {u_sql(salt, 'event_id')} < {p} THEN event_type ELSE {wrong} END"


def _sure_sql(salt: str, model: str) -> str:
    u = u_sql(salt, "id")
    return (
        f"CASE WHEN {model} = y THEN 0.35::DOUBLE + 0.65::DOUBLE * sqrt({u}) ELSE 0.25::DOUBLE + 0.70::DOUBLE * {u} END"
    )


PRED = f"""pred0 AS (
  SELECT event_id AS id, event_type AS y, {_guess_sql('a', 0.85)} AS a, {_guess_sql('b', 0.80)} AS b,
    CAST(json_extract_string(props, '$.k') AS INT) AS intent,
    (['english', 'mixed', 'short'])[1 + CAST(user_id % 3 AS INT)] AS slice, ts, value
  FROM events),
pred AS (SELECT *, {_sure_sql('c', 'a')} AS confidence, {_sure_sql('cb', 'b')} AS confidence_b FROM pred0)"""


# --- fine labels: k of events, folded onto the five classes ---------------------------


def intent_dim(spark: SparkSession, sf: str) -> DataFrame:
    """(intent, queue): the mapping, one row per k that occurs, kept as a table."""
    k = F.get_json_object("props", "$.k").cast("int")
    queue = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), F.col("intent") % 5 + 1)
    intents = table(spark, sf, "events").select(k.alias("intent")).distinct()
    return settle(intents.select("intent", queue.alias("queue")), "intent-dim")


DIM = """dim AS (SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS INT) AS intent,
  (['click','error','purchase','signup','view'])[1 + CAST(json_extract_string(props, '$.k') AS INT) % 5] AS queue
  FROM events)"""


def fine(spark: SparkSession, sf: str) -> DataFrame:
    """(id, intent, predicted_intent, direct): fine and direct predictions of one truth."""
    k = F.get_json_object("props", "$.k").cast("int")
    other = F.floor(uniform("f2", "event_id") * 100.0).cast("int")
    queue = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), k % 5 + 1)
    direct = F.when(uniform("d", "event_id") < F.lit(0.85), queue).otherwise(pick(CLASSES, uniform("d2", "event_id")))
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        k.alias("intent"),
        F.when(uniform("f", "event_id") < F.lit(0.8), k).otherwise(other).alias("predicted_intent"),
        direct.alias("direct"),
    )


FINE = f"""fine AS (SELECT event_id AS id, k AS intent,
  CASE WHEN {u_sql('f', 'event_id')} < 0.8 THEN k ELSE CAST(floor({u_sql('f2', 'event_id')} * 100.0::DOUBLE) AS INT) END
    AS predicted_intent,
  CASE WHEN {u_sql('d', 'event_id')} < 0.85 THEN (['click','error','purchase','signup','view'])[1 + k % 5]
    ELSE {pick_sql(CLASSES, u_sql('d2', 'event_id'))} END AS direct
  FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)),
{DIM},
folded AS (SELECT f.id, f.intent, f.predicted_intent, f.direct, d.queue AS y, p.queue AS mapped
  FROM fine f LEFT JOIN dim d ON f.intent = d.intent LEFT JOIN dim p ON f.predicted_intent = p.intent)"""


# --- raters ---------------------------------------------------------------------------


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """(item, rater, queue): the author and three raters on the language of a document."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("item"), "lang")
    entries = [F.struct(F.lit("author").alias("rater"), F.col("lang").alias("queue"))]
    for r in RATERS[1:]:
        other = pick(LANGS, uniform(f"{r}x", "item"))
        rated = F.when(uniform(r, "item") < F.lit(0.9), F.col("lang")).otherwise(other)
        entries.append(F.struct(F.lit(r).alias("rater"), rated.alias("queue")))
    return docs.select("item", F.inline(F.array(*entries)))


RATINGS = "ratings AS (SELECT doc_id AS item, 'author' AS rater, lang AS queue FROM documents" + "".join(
    f" UNION ALL SELECT doc_id, '{r}', CASE WHEN {u_sql(r, 'doc_id')} < 0.9 THEN lang "
    f"ELSE {pick_sql(LANGS, u_sql(r + 'x', 'doc_id'))} END FROM documents"
    for r in RATERS[1:]
) + ")"


def broken_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """The ratings with some rows missing and some queues unknown."""
    rows = ratings(spark, sf)
    kept = rows.where(uniform("miss", "item", "rater") >= F.lit(0.01))
    return kept.withColumn(
        "queue", F.when(uniform("unk", "item", "rater") < F.lit(0.01), F.lit("unknown")).otherwise(F.col("queue"))
    )


# --- versions -------------------------------------------------------------------------


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """(model, version, f1_macro, accuracy, data_source): one version per month and priority."""
    month = F.date_format("o_orderdate", "yyyyMM").cast("int")
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("model"), month.alias("version"))
        .agg(
            F.round(F.avg("o_totalprice") / 1e6, 4).alias("f1_macro"),
            F.round(F.avg((F.col("o_orderstatus") == "F").cast("double")), 4).alias("accuracy"),
        )
        .withColumn("data_source", F.concat(F.lit("corpus"), F.floor(F.col("version") / 100).cast("string")))
    )


VERSIONS = """versions AS (SELECT *, 'corpus' || CAST(version // 100 AS VARCHAR) AS data_source FROM (
  SELECT o_orderpriority AS model, CAST(strftime(o_orderdate, '%Y%m') AS INT) AS version,
    round(avg(o_totalprice) / 1e6, 4) AS f1_macro,
    round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS accuracy
  FROM orders GROUP BY 1, 2))"""


# --- personal data: a made-up value of each kind put behind every document ------------


def pii_cases(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, kind, pii, text) over all documents; the values are functions of the key."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    digest = F.md5(F.concat(F.lit("pii|"), F.col("doc_id").cast("string")))
    letters = F.translate(digest, "0123456789", "ghijklmnop")
    number = F.lpad(F.conv(F.substring(digest, 1, 10), 16, 10), 13, "0")
    four = F.substring(number, 8, 4)
    pan = F.concat(F.substring(letters, 1, 5), four, F.substring(letters, 6, 1))
    ifsc = F.concat(F.substring(letters, 7, 4), F.lit("0"), F.substring(number, 3, 6))
    upi = F.concat(F.lit("user."), F.substring(letters, 11, 4), F.lit("@ok"), F.substring(letters, 15, 4))
    email = F.concat(F.lit("u"), F.substring(digest, 1, 6), F.lit("@mail.example.org"))
    mobile = F.concat(F.substring(number, 1, 5), F.lit(" "), F.substring(number, 6, 5))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("doc_id") % 8 + 1).cast("int"))
    pii = (
        F.when(F.col("kind") == "email", email)
        .when(F.col("kind") == "upi", upi)
        .when(F.col("kind") == "pan", pan)
        .when(F.col("kind") == "ifsc", ifsc)
        .when(F.col("kind") == "mobile", mobile)
        .when(F.col("kind") == "fragment", four)
        .when(F.col("kind") == "multi", F.concat(upi, F.lit("|"), pan))
        .otherwise(F.lit(""))
    )
    shown = F.when(F.col("kind") == "fragment", F.concat(F.lit(" card ending in "), F.col("pii"))).otherwise(
        F.concat(F.lit(" id "), F.replace("pii", F.lit("|"), F.lit(" and ")), F.lit(" please"))
    )
    return (
        docs.withColumn("kind", kind)
        .withColumn("pii", pii)
        .select("doc_id", "kind", "pii", F.concat(F.col("text"), F.when(F.col("kind") == "none", "").otherwise(shown)).alias("text"))
    )


CASES = """cases0 AS (SELECT doc_id, text, md5('pii|' || doc_id) AS digest FROM documents),
cases1 AS (SELECT doc_id, text, digest, translate(digest, '0123456789', 'ghijklmnop') AS letters,
  lpad(CAST(CAST('0x' || substr(digest, 1, 10) AS BIGINT) AS VARCHAR), 13, '0') AS number,
  (['email','upi','pan','ifsc','mobile','fragment','multi','none'])[1 + CAST(doc_id % 8 AS INT)] AS kind FROM cases0),
cases2 AS (SELECT *, 'user.' || substr(letters, 11, 4) || '@ok' || substr(letters, 15, 4) AS upi,
  substr(letters, 1, 5) || substr(number, 8, 4) || substr(letters, 6, 1) AS pan FROM cases1),
cases3 AS (SELECT doc_id, kind, text, CASE kind WHEN 'email' THEN 'u' || substr(digest, 1, 6) || '@mail.example.org'
  WHEN 'upi' THEN upi WHEN 'pan' THEN pan
  WHEN 'ifsc' THEN substr(letters, 7, 4) || '0' || substr(number, 3, 6)
  WHEN 'mobile' THEN substr(number, 1, 5) || ' ' || substr(number, 6, 5)
  WHEN 'fragment' THEN substr(number, 8, 4) WHEN 'multi' THEN upi || '|' || pan ELSE '' END AS pii FROM cases2),
cases AS (SELECT doc_id, kind, pii, text || CASE kind WHEN 'none' THEN '' WHEN 'fragment' THEN ' card ending in ' || pii
  ELSE ' id ' || replace(pii, '|', ' and ') || ' please' END AS text FROM cases3)"""


# --- messages -------------------------------------------------------------------------


def training_texts(spark: SparkSession, sf: str, label: str = "quality") -> DataFrame:
    """(doc_id, text, label): labelled documents, cleaned. Both sides are joined on the key."""
    docs = balanced(table(spark, sf, "documents").select("doc_id", "text"))
    marks = table(spark, sf, "labels").select("doc_id", F.col(label).cast("string").alias("label"))
    return docs.join(marks, "doc_id").withColumn("text", clean_text(F.col("text")))


def tickets(conversations: DataFrame) -> DataFrame:
    """(ticket_id, ts, text): what users wrote, on a batch or a stream."""
    seconds = F.col("conv_id") * 60 + F.col("turn")
    return conversations.where(F.col("role") == "user").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("ticket_id"),
        F.timestamp_seconds(F.lit(1704067200) + seconds).alias("ts"),
        "text",
    )


CLEAN = r"trim(regexp_replace(lower({0}), '[\s\p{{Z}}\x0b\x1c-\x1f\x85]+', ' ', 'g'))"


def clean_sql(column: str) -> str:
    return CLEAN.format(column)


W = r"\p{L}\p{N}_"
REDACT_SQL = {
    "email": (rf"[{W}.+-]+@[{W}-]+(?:\.[{W}-]+)+", "[email]", "g"),
    "upi": (rf"\b[{W}.-]+@[a-z]{{2,}}\b", "[upi]", "gi"),
    "pan": (r"\b[a-z]{5}\d{4}[a-z]\b", "[pan]", "gi"),
    "ifsc": (r"\b[a-z]{4}0[a-z0-9]{6}\b", "[ifsc]", "gi"),
    "number": (r"\+?\b(?:\d[ -]?){7,}\d\b", "[number]", "g"),
    "fragment": (r"(\bending(?: in| with)? |x{2,} ?)\d{4}\b", r"\1[number]", "gi"),
}


def redact_sql(column: str, rules: tuple[str, ...] = tuple(REDACT_SQL)) -> str:
    for rule in rules:
        pattern, token, flags = REDACT_SQL[rule]
        column = f"regexp_replace({column}, '{pattern}', '{token}', '{flags}')"
    return column
