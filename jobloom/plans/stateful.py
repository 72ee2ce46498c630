"""Queries over state: merges of versions, commits, history, ordered delivery, channels and crawls, with the SQL that says
from the tables what they must give."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobloom.functions import entities
from jobloom.operators import postings, state_merge
from jobloom.plans import history, oracle, publish, storage
from jobloom.plans.fixtures import raw_postings, table
from jobloom.sources import channels, messages
from jobloom.streaming import delivery

c = F.col
QUERIES: dict = {}
SQL: dict[str, str] = {}


def checked(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# --- documents on three sides

#: Each side's fields: SQL of the value, or NULL where the side lacks it; ``meta`` is an object of the fields below it.
_SIDES = {
    "b": {"here": "k % 4 <> 3", "title": "pri", "company": "'c' || cust", "meta": "true", "meta.status": "status", "meta.price": "price", "meta.tags": "'[1,' || k % 5 || ']'", "meta.deep": "k % 9 <> 1", "meta.deep.a": "'x' || k % 3", "meta.deep.b": "'y'"},
    "l": {"here": "k % 9 <> 4", "title": "CASE WHEN k % 5 = 0 THEN 'L' ELSE pri END", "company": "'c' || cust", "meta": "k % 11 <> 3", "meta.status": "status", "meta.price": "CASE WHEN k % 7 = 0 THEN -1 ELSE price END", "meta.note": "CASE WHEN k % 7 = 0 THEN 'n' END", "meta.tags": "'[1,' || k % 5 || ']'", "meta.deep": "k % 9 <> 1 AND k % 8 <> 5", "meta.deep.a": "'x' || k % 3", "meta.deep.b": "CASE WHEN k % 6 <> 1 THEN 'y' END"},
    "r": {"here": "k % 10 <> 7", "title": "pri", "company": "CASE WHEN k % 6 = 0 THEN 'R' ELSE 'c' || cust END", "meta": "true", "meta.status": "CASE WHEN k % 8 = 0 THEN 'r' ELSE status END", "meta.price": "CASE WHEN k % 13 = 5 THEN -2 ELSE price END", "meta.tags": "CASE WHEN k % 17 = 1 THEN '[9]' ELSE '[1,' || k % 5 || ']' END", "meta.deep": "k % 9 <> 1", "meta.deep.a": "CASE WHEN k % 12 = 5 THEN 'z' ELSE 'x' || k % 3 END", "meta.deep.b": "'y'"},
}
_RAW = {"meta.price", "meta.tags"}
_TREE = {"": ["company", "meta", "title"], "meta": ["deep", "note", "price", "status", "tags"], "meta.deep": ["a", "b"]}
_BASE_ROWS = "o AS (SELECT o_orderkey AS k, o_custkey AS cust, o_orderpriority AS pri, o_orderstatus AS status, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders)"


def _documents(spark, d, side: str) -> DataFrame:
    o = table(spark, d, "orders").select(c("o_orderkey").alias("k"), c("o_custkey").alias("cust"), c("o_orderpriority").alias("pri"), c("o_orderstatus").alias("status"), F.floor("o_totalprice").cast("long").alias("price"))
    fields = _SIDES[side]

    def build(path: str) -> Column:
        parts = []
        for name in _TREE[path]:
            at = f"{path}.{name}" if path else name
            if at not in fields:
                continue
            if at in _TREE:
                parts.append(F.when(F.expr(fields[at]), F.concat(F.lit(f'"{name}":'), build(at))))
            else:
                quote = "" if at in _RAW else '"'
                value = F.expr(fields[at]).cast("string")
                parts.append(F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":{quote}'), value, F.lit(quote))))
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))

    return o.where(fields["here"]).select(c("k").cast("string").alias("key"), build("").alias("document"))


_PATHS = ["", *[f"{p}.{n}" if p else n for p, names in _TREE.items() for n in names]]


def _children(at: str) -> list[tuple[str, str]]:
    return [(n, f"{at}.{n}" if at else n) for n in _TREE[at]]


def _merge_sql(kept_history: bool) -> str:
    """The merge of these documents, spelled out path by path from the rule: deletion of the whole path first, then objects
    field by field, then values. ``b3`` is the JSON text of the fourth path on the base's side, null where it lacks the path."""
    name = lambda side, at: f"{side}{_PATHS.index(at)}"

    def text(side: str, at: str) -> str:
        if at not in _TREE:
            quote = "" if at in _RAW else '"'
            return f"'{quote}' || CAST({_SIDES[side].get(at, 'NULL')} AS VARCHAR) || '{quote}'"
        inner = ", ".join(f"""'"{n}":' || {text(side, child)}""" for n, child in _children(at))
        return f"CASE WHEN {_SIDES[side].get(at or 'here', 'false')} THEN '{{' || concat_ws(',', {inner}) || '}}' END"

    def present(side: str, at: str) -> str:
        above = ["here", *[".".join(at.split(".")[:i]) for i in range(1, len(at.split(".")))]]
        return " AND ".join(f"({_SIDES[side].get(x, 'false')})" for x in above)

    own = {side: {at: f"CASE WHEN {present(side, at)} THEN {text(side, at)} END" for at in _PATHS} for side in "blr"}
    gone = lambda b, le, r: f"coalesce(({le} IS NULL AND ({r} IS NULL OR {r} = {b})) OR ({r} IS NULL AND {le} = {b}), false)"
    of = lambda at: [name(side, at) for side in "blr"]

    def merged(at: str) -> str:
        b, le, r = of(at)
        if at not in _TREE:
            return f"CASE WHEN {gone(b, le, r)} THEN NULL WHEN {le} IS NOT DISTINCT FROM {b} THEN {r} ELSE {le} END"
        return f"CASE WHEN NOT {gone(b, le, r)} THEN '{{' || concat_ws(',', " + ", ".join(f"""'"{n}":' || {merged(child)}""" for n, child in _children(at)) + ") || '}' END"

    def fight(at: str) -> str:
        b, le, r = of(at)
        if at not in _TREE:
            return f"(NOT {gone(b, le, r)} AND {le} IS DISTINCT FROM {r} AND {le} IS DISTINCT FROM {b} AND {r} IS DISTINCT FROM {b})"
        return f"(NOT {gone(b, le, r)} AND (" + " OR ".join(fight(child) for _, child in _children(at)) + "))"

    columns = []
    for at in _PATHS:
        columns.append(f"{own['b'][at]} AS {name('b', at)}")
        for side in "lr":
            kept = f"CASE WHEN {_SIDES[side]['here']} THEN {own[side][at]} ELSE {own['b'][at]} END"
            columns.append(f"{kept if kept_history else own[side][at]} AS {name(side, at)}")
    some = " OR ".join(f"({_SIDES[side]['here']})" for side in "blr")
    return f"""WITH {_BASE_ROWS}, x AS (SELECT CAST(k AS VARCHAR) AS key, {', '.join(columns)} FROM o WHERE {some}), z AS (SELECT key, {fight('')} AS fight, {merged('')} AS document FROM x)
SELECT key, CASE WHEN NOT fight THEN document END AS document, CASE WHEN fight THEN 'conflict' WHEN document IS NULL THEN 'deleted' ELSE 'kept' END AS status FROM z"""


@checked(_merge_sql(False))
def q_merge_documents(spark, d):
    """Orders as nested documents that two sides changed, dropped and added to."""
    return state_merge.merge_documents(*[_documents(spark, d, s) for s in "blr"]).select("key", "document", "status")


@checked(_merge_sql(True))
def q_merge_history(spark, d):
    """The same as a history: what a side dropped stays."""
    return state_merge.merge_documents(*[_documents(spark, d, s) for s in "blr"], history=True).select("key", "document", "status")


_SLOTS = "b AS (SELECT CAST(ts AS DATE) AS day, hour(ts) // 8 AS slot, event_id % 6 AS w FROM events)"


@checked(f"""WITH {_SLOTS}, u AS (SELECT day, list_sort(list_distinct(list(slot))) AS slots FROM b WHERE w < 5 GROUP BY 1)
SELECT 'days' AS key, '{{' || string_agg('"' || day || '":{{"slots":[' || array_to_string(slots, ',') || ']}}', ',' ORDER BY day) || '}}' AS document, 'kept' AS status FROM u""")
def q_merge_slots(spark, d):
    """Slots claimed on three sides: the lists of a day are united, whoever dropped one."""
    e = table(spark, d, "events").select(F.to_date("ts").cast("string").alias("day"), F.floor(F.hour("ts") / 8).alias("slot"), (c("event_id") % 6).alias("w"))

    def side(when: str) -> DataFrame:
        days = e.where(when).groupBy("day").agg(F.array_sort(F.collect_set("slot")).alias("slots"))
        return days.agg(F.map_from_entries(F.collect_list(F.struct("day", F.struct("slots")))).alias("m")).select(F.lit("days").alias("key"), F.to_json("m").alias("document"))

    return state_merge.merge_documents(side("w < 2"), side("w IN (1, 2, 3)"), side("w IN (0, 3, 4)"), union="slots").select("key", "document", "status")


# --- commits


@checked(f"""WITH {_BASE_ROWS} SELECT CAST(k AS VARCHAR) AS key, '{{"mine":' || CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END || ',"price":' || CASE WHEN k % 5 = 0 THEN -1 ELSE price END || '}}' AS document FROM o WHERE k % 7 <> 0 OR k % 3 = 0 UNION ALL SELECT 'new', '{{"mine":2}}'""")
def q_publish(spark, d):
    """Two writers start from one version: the second finds its version taken, merges with the first one's and commits after it."""
    path = storage.new_folder(spark, "published")
    o = table(spark, d, "orders").select(c("o_orderkey").alias("k"), F.floor("o_totalprice").cast("long").alias("price"), F.lit(0).alias("mine"))
    documents = lambda df: df.select(c("k").cast("string").alias("key"), F.to_json(F.struct("mine", "price")).alias("document"))
    first = storage.replace_table(documents(o), path)
    publish.publish(documents(o.withColumn("mine", F.when(c("k") % 3 == 0, 1).otherwise(0))).union(spark.createDataFrame([("new", '{"mine":2}')], publish.STATE)), path, first.version)
    publish.publish(documents(o.where("k % 7 <> 0 OR k % 3 = 0").withColumn("price", F.when(c("k") % 5 == 0, F.lit(-1)).otherwise(c("price")))), path, first.version)
    return storage.read_table(spark, path, publish.STATE)


# --- history


@checked("""WITH r AS (SELECT o_custkey || '/' || o_orderpriority AS key, o_orderkey AS seq, o_orderkey % 6 AS run FROM orders)
SELECT key, run, seq FROM r QUALIFY row_number() OVER (PARTITION BY key ORDER BY run, seq) = 1""")
def q_history_runs(spark, d):
    """Six runs that append what the history lacks; small segments are merged on the way."""
    path, schema = storage.new_folder(spark, "history"), "key string, run long, seq long"
    rows = table(spark, d, "orders").select(F.concat_ws("/", c("o_custkey").cast("string"), "o_orderpriority").alias("key"), (c("o_orderkey") % 6).alias("run"), c("o_orderkey").alias("seq"))
    for run in range(6):
        history.append_new(rows.where(c("run") == run), path, "key", "seq", ["key", "run", "seq"])
        if run % 4 == 3:
            history.compact(spark, path, schema)
    return history.read(spark, path, schema).drop("bucket")


# --- character references

_NAMES = sorted(html5)


@checked("WITH n AS (SELECT unnest([" + ", ".join(oracle.q(n) for n in _NAMES) + "]) AS name, unnest([" + ", ".join("'" + html5[n].replace("'", "''") + "'" for n in _NAMES) + f"""]) AS said, unnest(range({len(_NAMES)})) AS i)
SELECT page_id, 'a' || said || ' <' || chr(CAST(9000 + page_id % 900 AS INT)) || '&lt; ' || regexp_extract(url, '^[^?#]*') || '&' AS text FROM pages JOIN n ON page_id % {len(_NAMES)} = i""")
def q_entities(spark, d):
    """Every named reference, numbers in both notations, references made by references, and loose ampersands."""
    k = c("page_id")
    names = F.array(*[F.lit(n) for n in _NAMES])
    text = F.concat(F.lit("a&"), F.get(names, (k % len(_NAMES)).cast("int")), F.lit(" <&#"), F.when(k % 2 == 0, (k % 900 + 9000).cast("string")).otherwise(F.concat(F.lit("x"), F.hex(k % 900 + 9000))), F.lit(";&amp;lt; "), F.regexp_extract("url", "^[^?#]*", 0), F.lit("&"))
    return table(spark, d, "pages").select("page_id", entities.unescape(text).alias("text"))


# --- ordered delivery

_DUE = f"""{oracle.BASE}, due AS (SELECT *, {oracle.family('title')} AS fam, seq % 3 AS batch FROM norm WHERE track = 'ai' OR ({oracle.topic('title', 'description')}) IS NOT NULL QUALIFY row_number() OVER (PARTITION BY canonical_url ORDER BY seq % 3, seq) = 1),
told AS (SELECT *, company <> '' AND title <> '' AND row_number() OVER (PARTITION BY cc, fam, CASE WHEN company <> '' AND title <> '' THEN '' ELSE CAST(seq AS VARCHAR) END ORDER BY batch, seq) > 1 AS repeat FROM due)"""


def _delivered(spark, d) -> delivery.Stores:
    """Three batches of postings handed over, the second of them broken off after its feed and repeated."""
    stores = delivery.Stores(storage.new_folder(spark, "delivered"))
    normal = storage.stash(postings.normalize(raw_postings(spark, d)), "normal")

    def break_off(step: str) -> None:
        if step == "feed":
            raise ConnectionError("lost")

    for batch in range(3):
        rows = normal.where(c("seq") % 3 == batch)
        cursors = rows.groupBy(c("source").alias("channel")).agg(F.max("seq").alias("cursor"))
        hand_over = lambda **more: delivery.deliver_batch(rows, batch, stores, F.lit(f"run {batch}"), cursors=cursors, **more)  # noqa: B023, E731
        if batch == 1:
            try:
                hand_over(after=break_off)
            except ConnectionError:
                pass
        hand_over()
    return stores


@checked(f"{_DUE} SELECT canonical_url AS key, title, company, 'run ' || batch AS first_seen, repeat, CASE WHEN NOT repeat AND {oracle.inbox('track', 'title')} THEN batch END AS digest FROM told")
def q_ordered_delivery(spark, d):
    """The history, with the feed's repeat flag and the batch of the digest each posting stood in."""
    stores = _delivered(spark, d)
    read = lambda path, schema: storage.read_table(spark, path, schema)
    feed = read(stores.feed, "feed_key string, repeat_of_seen_role boolean").select(c("feed_key").alias("key"), c("repeat_of_seen_role").alias("repeat"))
    digest = read(stores.digest, "key string, batch long").select("key", c("batch").alias("digest"))
    return read(stores.history, delivery.HISTORY).join(feed, "key", "full_outer").join(digest, "key", "full_outer")


# --- channels

_CHANNEL = "CASE WHEN user_id % 10 = 0 THEN 'hirifyme_bot' ELSE 'ch' || user_id END"
_MESSAGES = f"m AS (SELECT {_CHANNEL} AS channel, event_id AS message_id, CASE WHEN event_id % 9 <> 0 THEN ts END AS published_at, user_id FROM events)"
_NOW = "2024-02-10 00:00:00"


def _channel_messages(spark, d) -> tuple[DataFrame, DataFrame]:
    u = c("user_id")
    m = table(spark, d, "events").select(F.when(u % 10 == 0, "hirifyme_bot").otherwise(F.concat(F.lit("ch"), u.cast("string"))).alias("channel"), c("event_id").alias("message_id"), F.when(c("event_id") % 9 != 0, c("ts").cast("timestamp")).alias("published_at"), "user_id")
    cursors = m.where("user_id % 2 = 1").groupBy("channel").agg((F.max("message_id") - 3000).alias("cursor"))
    return m.drop("user_id"), cursors


def _read(batch: DataFrame) -> DataFrame:
    emits = messages.emitted(batch, F.lit(_NOW).cast("timestamp")).select("channel", "message_id", F.lit(True).alias("emits"))
    return batch.select("channel", "message_id", "mode").join(emits, ["channel", "message_id"], "left").withColumn("emits", F.coalesce("emits", F.lit(False)))


_OLD = f"channel <> 'hirifyme_bot' AND published_at < TIMESTAMP '{_NOW}' - INTERVAL 30 DAY"


@checked(f"""WITH {_MESSAGES}, k AS (SELECT channel, max(message_id) - 3000 AS cursor FROM m WHERE user_id % 2 = 1 GROUP BY 1),
j AS (SELECT m.*, cursor, CASE WHEN cursor IS NOT NULL THEN 'catch_up' WHEN channel = 'hirifyme_bot' THEN 'first' ELSE 'lookback' END AS mode FROM m LEFT JOIN k USING (channel)),
s AS (SELECT * FROM j WHERE cursor IS NULL OR message_id > cursor QUALIFY row_number() OVER (PARTITION BY channel ORDER BY CASE WHEN mode = 'catch_up' THEN message_id ELSE -message_id END) <= CASE mode WHEN 'catch_up' THEN 3000 WHEN 'lookback' THEN 100 ELSE 1 END)
SELECT channel, message_id, mode, mode <> 'first' AND NOT coalesce({_OLD}, false) AS emits FROM s""")
def q_channel_modes(spark, d):
    """A run's reading of every channel: after a cursor, a first look at others, and a bot that is only started."""
    return _read(messages.select_batch(*_channel_messages(spark, d)))


@checked(f"""WITH {_MESSAGES}, k AS (SELECT channel, max(message_id) - 3000 AS cursor FROM m WHERE user_id % 2 = 1 GROUP BY 1),
t AS (SELECT channel, max(message_id) AS stop FROM m WHERE published_at < TIMESTAMP '2024-01-20' GROUP BY 1),
s AS (SELECT m.*, CASE WHEN channel = 'hirifyme_bot' THEN 'first' ELSE 'backfill' END AS mode FROM m LEFT JOIN t USING (channel) WHERE channel = 'hirifyme_bot' OR stop IS NULL OR message_id > stop QUALIFY row_number() OVER (PARTITION BY channel ORDER BY -message_id) <= CASE WHEN mode = 'first' THEN 1 ELSE 30000 END)
SELECT channel, message_id, mode, mode <> 'first' AS emits FROM s""")
def q_channel_backfill(spark, d):
    """Channels read again from a day on, newest first until a message from before it."""
    m, cursors = _channel_messages(spark, d)
    return _read(messages.select_batch(m, cursors, since=F.lit("2024-01-20").cast("timestamp")))


@checked("""WITH m AS (SELECT 'ch' || user_id % 12 AS channel, event_id AS message_id, event_type AS text, user_id % 12 AS u FROM events),
k AS (SELECT channel, message_id, text, u, row_number() OVER (PARTITION BY channel ORDER BY message_id DESC) AS newest, row_number() OVER (PARTITION BY channel ORDER BY message_id) AS oldest FROM m)
SELECT channel, message_id, text FROM k WHERE CASE WHEN u % 3 = 0 THEN message_id > 400 WHEN u % 3 = 1 THEN newest <= 100 ELSE false END""")
def q_channel_stream(spark, d):
    """Captured messages as a stream: channels after their cursor to the end, the latest of new ones, and bots that only start."""
    root = storage.new_folder(spark, "channels")
    e = table(spark, d, "events").select(F.concat(F.lit("ch"), (c("user_id") % 12).cast("string")).alias("channel"), c("event_id").alias("message_id"), c("event_type").alias("text"), c("ts").cast("timestamp").alias("published_at"))
    e.repartitionByRange("channel", "message_id").sortWithinPartitions("channel", "message_id").write.option("maxRecordsPerFile", 50_000).parquet(f"{root}/captured")
    spark.dataSource.register(channels.MessageChannels)
    options = {"path": f"{root}/captured", "position": f"{root}/position/offset.json", "cursors": json.dumps({f"ch{i}": 400 for i in range(0, 12, 3)}), "bots": json.dumps([f"ch{i}" for i in range(2, 12, 3)])}
    stream = spark.readStream.format("message_channels").options(**options).load()
    query = stream.writeStream.format("parquet").option("path", f"{root}/read").option("checkpointLocation", f"{root}/checkpoint").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(channels.SCHEMA).parquet(f"{root}/read").select("channel", "message_id", "text")
