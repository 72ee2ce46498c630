"""State: merges, commits, history, ordered delivery and channels against plain models."""

import html
import json
import os
import random
import threading
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from jobloom.functions import columns as C
from jobloom.functions.entities import unescape
from jobloom.operators import postings, state_merge, watchlist
from jobloom.plans import history, publish, stateful, storage
from jobloom.sources import channels, messages
from jobloom.streaming import delivery
from tests.oracle import rows_of, sql_rows


@pytest.mark.parametrize("name", sorted(stateful.QUERIES))
def test_query(spark, sf_dir, name):
    got = rows_of(stateful.QUERIES[name](spark, sf_dir))
    assert got == sql_rows(stateful.SQL[name], sf_dir) and got[1]


# --- merges

ABSENT = object()


class Fight(Exception):
    pass


def merge_model(base, local, remote, union, keys=()):
    there = [v for v in (base, local, remote) if v is not ABSENT]
    same = lambda x, y: x is y if ABSENT in (x, y) else json.dumps(x, sort_keys=True) == json.dumps(y, sort_keys=True)
    if union and keys and keys[-1] == union:
        if not all(isinstance(v, list) and all(type(x) is int for x in v) for v in there):
            raise Fight
        return sorted({x for v in there for x in v})
    if local is ABSENT and (remote is ABSENT or same(remote, base)) or remote is ABSENT and same(local, base):
        return ABSENT
    if all(isinstance(v, dict) for v in there):
        out = {}
        for k in sorted(set().union(*there)):
            v = merge_model(*[s.get(k, ABSENT) if isinstance(s, dict) else ABSENT for s in (base, local, remote)], union, (*keys, k))
            if v is not ABSENT:
                out[k] = v
        return out
    for x, y, z in ((local, remote, local), (local, base, remote), (remote, base, local)):
        if same(x, y):
            return z
    raise Fight


def _sides(seed=5, n=400):
    rnd = random.Random(seed)

    def value(depth=0):
        if depth < 4 and rnd.random() < 0.6:
            return {k: value(depth + 1) for k in rnd.sample(["a", "b", 'c"]:', "é", "slots"], rnd.randint(0, 3))}
        return rnd.choice([1, 2, "x", None, True, [1, 2], [3], [], "y"])

    def edit(v):
        if isinstance(v, dict):
            out = {k: (edit(x) if rnd.random() < 0.4 else x) for k, x in v.items() if rnd.random() > 0.15}
            return out | ({rnd.choice("abn"): value(3)} if rnd.random() < 0.2 else {})
        return value(3) if rnd.random() < 0.5 else v

    sides = {s: {} for s in "blr"}
    for i in range(n):
        v = value()
        if rnd.random() < 0.85:
            sides["b"][f"k{i}"] = v
        for s in "lr":
            if rnd.random() < 0.85:
                sides[s][f"k{i}"] = edit(v) if rnd.random() < 0.6 else v
    return sides


@pytest.mark.parametrize("kept,union", [(False, None), (True, None), (False, "slots")])
def test_merge_equals_the_recursive_model(spark, kept, union):
    sides = _sides()
    frame = lambda s: spark.createDataFrame([(k, json.dumps(v)) for k, v in sides[s].items()], publish.STATE)
    got = {r.key: r for r in state_merge.merge_documents(*map(frame, "blr"), history=kept, union=union).collect()}
    seen = set()
    for k in set().union(*sides.values()):
        base, local, remote = (sides[s].get(k, ABSENT) for s in "blr")
        if kept:
            local, remote = (base if v is ABSENT else v for v in (local, remote))
        try:
            want = merge_model(base, local, remote, union)
            want = (None, "deleted") if want is ABSENT else (want, "kept")
        except Fight:
            want = (None, "conflict")
        seen.add(want[1])
        r = got.pop(k)
        assert (json.loads(r.document) if r.document is not None else None, r.status) == want and (r.depth is not None) == (r.status == "conflict")
    assert not got and seen >= {"kept", "conflict"}


def _state(spark, **documents):
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in documents.items()], publish.STATE)


def _published(spark, path):
    return {r.key: json.loads(r.document) for r in storage.read_table(spark, path, publish.STATE).collect()}


def test_history_is_kept_when_a_side_was_emptied(spark):
    path = storage.new_folder(spark, "t")
    first = storage.replace_table(_state(spark, old={"title": "iOS"}), path).version
    assert publish.publish(_state(spark, other={"x": 1}), path, first, history=True) == first + 1
    assert _published(spark, path) == {"old": {"title": "iOS"}, "other": {"x": 1}}
    assert publish.publish(_state(spark, old={"title": "iOS"}), path, first, history=True) is None


def test_conflicts_fail_the_commit_and_name_no_key(spark):
    path = storage.new_folder(spark, "t")
    first = storage.replace_table(_state(spark, secret={"title": "a"}), path).version
    publish.publish(_state(spark, secret={"title": "b"}), path, first)
    with pytest.raises(state_merge.StateConflict, match="1 at depth 1") as error:
        publish.publish(_state(spark, secret={"title": "c"}), path, first)
    assert "secret" not in str(error.value) and _published(spark, path) == {"secret": {"title": "b"}}


def test_two_writers_at_once_both_commit(spark, monkeypatch):
    path = storage.new_folder(spark, "t")
    first = storage.replace_table(_state(spark, a={"n": 0}, b={"n": 0}), path).version
    together, create, lost = threading.Barrier(2), storage._Log.create, []

    def race(log, now):
        if now.version == first + 1:
            together.wait(60)
        made = create(log, now)
        lost.extend([] if made else [now.version])
        return made

    monkeypatch.setattr(storage._Log, "create", race)
    runs = [threading.Thread(target=publish.publish, args=(_state(spark, **{"a": {"n": 0}, "b": {"n": 0}, k: {"n": 1}}), path, first)) for k in "ab"]
    [t.start() for t in runs], [t.join() for t in runs]
    assert lost == [first + 1] and _published(spark, path) == {"a": {"n": 1}, "b": {"n": 1}}
    assert storage.snapshot(spark, path).version == first + 2


def test_a_refused_write_is_not_retried_and_endless_races_end(spark, monkeypatch):
    path, calls = storage.new_folder(spark, "t"), []
    storage.replace_table(spark.range(1), path)
    monkeypatch.setattr(storage._Log, "create", lambda log, now: bool(calls.append(now.version)))
    with pytest.raises(PermissionError):
        storage.replace_table(spark.range(2), path)
    assert calls == [2]
    versions = iter(range(1, 1000))
    monkeypatch.setattr(storage._Log, "versions", lambda log: [next(versions)])
    monkeypatch.setattr(storage._Log, "read", lambda log, version: storage.Snapshot(version))
    with pytest.raises(storage.Conflict):
        storage.update(spark, path, lambda now: now)
    assert len(calls) == 1 + storage.ATTEMPTS


def test_a_version_that_moved_on_is_not_replaced(spark):
    path = storage.new_folder(spark, "t")
    first = storage.replace_table(spark.range(3), path).version
    storage.replace_table(spark.range(5), path, expected=first)
    with pytest.raises(storage.Conflict):
        storage.replace_table(spark.range(1), path, expected=first)
    assert storage.read_table(spark, path, "id long").count() == 5 and storage.read_table(spark, path, "id long", first).count() == 3


# --- history


def _keys(spark, *ids):
    return spark.createDataFrame([(str(i), i) for i in ids], "key string, n long")


def _size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path.removeprefix("file:").replace("//", "/")) for f in names if f.endswith(".parquet"))


def test_history_is_neither_shuffled_nor_rewritten(spark):
    path = storage.new_folder(spark, "h")
    history.append_new(_keys(spark, *range(3000)), path, "key", "n", ["key", "n"])
    before = _size(path)
    now = history.append_new(_keys(spark, 5, 2999, 3000, 3001, 3001), path, "key", "n", ["key", "n"])
    assert [s.rows for s in now.segments] == [3000, 2] and _size(path) - before < before / 10
    run = _keys(spark, 1, 2).withColumn("bucket", history.bucket_of("key"))
    plan = history.known_keys(run, path, now, "key")._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("FileScan")
    assert "Exchange hashpartitioning" not in plan and "PartitionFilters: [bucket" in plan[scan:] and "ReadSchema: struct<key:string>" in plan
    assert now.version == history.append_new(_keys(spark, 1, 2), path, "key", "n", ["key", "n"]).version


def test_batches_are_written_once_and_small_segments_merged(spark):
    path = storage.new_folder(spark, "h")
    for batch in range(6):
        for _ in range(2):
            now = history.append_new(_keys(spark, *range(batch * 5, batch * 5 + 10)), path, "key", "n", ["key", "n"], writer="w", batch=batch)
    assert sum(s.rows for s in now.segments) == 35 and len(now.segments) == 6
    after = history.compact(spark, path, "key string, n long")
    assert len(after.segments) < 6 and after.batches == now.batches
    assert sorted(int(r.key) for r in history.read(spark, path, "key string, n long").collect()) == list(range(35))


def test_appends_that_race_keep_each_key_once(spark, monkeypatch):
    path = storage.new_folder(spark, "h")
    together, create = threading.Barrier(2), storage._Log.create
    monkeypatch.setattr(storage._Log, "create", lambda log, now: (together.wait(60) if now.version == 1 else 0, create(log, now))[1])
    runs = [threading.Thread(target=history.append_new, args=(_keys(spark, *ids), path, "key", "n", ["key", "n"])) for ids in (range(10), range(5, 15))]
    [t.start() for t in runs], [t.join() for t in runs]
    assert sorted(int(r.key) for r in history.read(spark, path, "key string, n long").collect()) == list(range(15))


# --- delivery

STEPS = ("digest", "feed", "roles", "history", "cursors")


def _postings(spark, rows):
    raw = spark.createDataFrame([(i, co, t, f"https://x.io/{u}", "company", None, None, None, None, None, "ios", False) for i, co, t, u in rows], postings.RAW)
    return postings.normalize(raw)


def _contents(spark, stores):
    read = lambda name, schema, *cols: sorted(tuple(r) for r in storage.read_table(spark, getattr(stores, name), schema).select(*cols).collect())
    return {
        "digest": read("digest", "key string, title string, batch long", "key", "title", "batch"), "feed": read("feed", "feed_key string, repeat_of_seen_role boolean", "feed_key", "repeat_of_seen_role"),
        "history": read("history", delivery.HISTORY, "key", "title", "first_seen"), "roles": read("roles", delivery.ROLES, "key"), "cursors": read("cursors", delivery.CURSORS, "channel", "cursor"),
    }


BATCHES = [[(1, "Acme", "iOS Developer", "a"), (2, "Acme", "Senior iOS Developer", "b"), (3, "", "iOS Engineer", "c")], [(4, "Acme", "iOS Engineer", "d"), (5, "Beta", "iOS Developer", "e"), (6, "Acme", "iOS Developer", "a")]]


@pytest.mark.parametrize("step", STEPS)
def test_a_batch_broken_off_after_any_step_ends_as_if_it_had_not_been(spark, step):
    def run(root, breaks):
        stores, sent = delivery.Stores(storage.new_folder(spark, root)), []
        for batch, rows in enumerate(BATCHES):
            cursors = spark.createDataFrame([("ch", 10 * (batch + 1))], delivery.CURSORS)

            def fail(done):
                if breaks and batch == 1 and done == step:
                    raise ConnectionError(step)

            try:
                delivery.deliver_batch(_postings(spark, rows), batch, stores, F.lit(f"day {batch}"), cursors=cursors, after=fail, send=lambda df: sent.append(df.count()))
            except ConnectionError:
                delivery.deliver_batch(_postings(spark, rows), batch, stores, F.lit(f"day {batch}"), cursors=cursors, send=lambda df: sent.append(df.count()))
        return _contents(spark, stores), sent

    got = run("broken", True)
    assert got == run("whole", False)
    tables, sent = got
    assert sent == [2, 1] and tables["cursors"] == [("ch", 20)]
    assert [k for k, *_ in tables["history"]] == [f"https://x.io/{u}" for u in "abcde"]
    assert dict(tables["feed"]) == {"https://x.io/a": False, "https://x.io/b": True, "https://x.io/c": False, "https://x.io/d": True, "https://x.io/e": False}
    assert [(k[-1], b) for k, _, b in tables["digest"]] == [("a", 0), ("c", 0), ("e", 1)]


def test_a_failing_messenger_leaves_everything_new(spark):
    stores = delivery.Stores(storage.new_folder(spark, "failing"))

    def refuse(df):
        raise ConnectionError

    with pytest.raises(ConnectionError):
        delivery.deliver_batch(_postings(spark, BATCHES[0]), 0, stores, F.lit("d"), send=refuse)
    assert not any(_contents(spark, stores).values())
    delivery.deliver_batch(_postings(spark, BATCHES[0]), 0, stores, F.lit("d"), quiet=True)
    assert not _contents(spark, stores)["digest"] and len(_contents(spark, stores)["feed"]) == 3
    delivery.deliver_batch(_postings(spark, BATCHES[0]), 1, stores, F.lit("d"), gate=False)
    got = _contents(spark, stores)
    assert len(got["digest"]) == 3 and len(got["feed"]) == len(got["history"]) == 3


# --- channels


def _captured(spark, path, rows):
    spark.createDataFrame(rows, "channel string, message_id long, text string, published_at timestamp").coalesce(1).write.mode("append").parquet(path)


def test_channel_stream_resumes_where_it_stood(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    rows = lambda ch, ids: [(ch, i, f"{ch}{i}", None) for i in ids]
    spark.dataSource.register(channels.MessageChannels)
    options = {"path": src, "position": str(tmp_path / "pos" / "offset.json"), "cursors": json.dumps({"old": 5, "bad": 0}), "catch_up": "4", "lookback": "3", "bots": '["bot"]'}

    def run():
        stream = spark.readStream.format("message_channels").options(**options).load()
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return sorted((r.channel, r.message_id) for r in spark.read.parquet(out).collect())

    _captured(spark, src, rows("old", range(1, 16)) + rows("new", range(1, 9)) + rows("bot", range(1, 5)) + [("old", None, "x", None), (None, 3, "x", None)])
    first = run()
    assert first == [("new", i) for i in (6, 7, 8)] + [("old", i) for i in range(6, 16)]
    assert run() == first
    _captured(spark, src, rows("old", range(16, 18)) + rows("new", [9, 20]) + rows("bot", [7]) + rows("bad", [1]))
    assert run() == sorted(first + [("old", 16), ("old", 17), ("new", 9), ("new", 20), ("bot", 7), ("bad", 1)])


def test_cursors_after_each_mode(spark):
    m = spark.createDataFrame([("a", i, None) for i in range(1, 8)] + [("b", 4, None), ("b", 9, None), ("hirifyme_bot", 3, None), ("c", None, None)], "channel string, message_id long, published_at timestamp")
    cursors = spark.createDataFrame([("a", 2)], delivery.CURSORS)
    batch = messages.select_batch(m, cursors, catch_up=3, lookback=1)
    assert {(r.channel, r.cursor, r.scanned) for r in messages.next_cursors(batch).collect()} == {("a", 5, 3), ("b", 9, 1), ("hirifyme_bot", 3, 1)}
    back = messages.select_batch(m, cursors, since=F.lit("2024-01-01").cast("timestamp"))
    assert {r.channel for r in messages.next_cursors(back).collect()} == {"hirifyme_bot"} and back.count() == 10


def test_bot_messages(spark):
    m = [("hirifyme_bot", 1, "iOS Developer в Acme\nhttps://hirify.me/jobs/77", ["https://hirify.me/jobs/77?x"]), ("hirifyme_bot", 2, "iOS Developer в Acme", []), ("ch", 3, "#vacancy iOS Developer", []), ("hirifyme_bot", 4, "#vacancy iOS Developer", [])]
    df = spark.createDataFrame([(*r[:3], None, r[3]) for r in m], "channel string, message_id long, text string, published_at timestamp, urls array<string>")
    got = {r.source_job_id: (r.company, r.title, r.source) for r in messages.postings_from_messages(df).collect()}
    assert got["hirify:77"] == ("Acme", "iOS Developer", "hirify.me") and got["ch:3"][2] == "telegram" and len(got) == 2
    assert {(r.channel, r.messages, r.malformed) for r in messages.malformed_counts(df).collect()} == {("hirifyme_bot", 3, 1), ("ch", 1, 0)}


# --- rules of links and text


def test_link_scores(spark):
    rows = [("https://x.teamtailor.com/", "", 100), ("https://acme.io/blog/greenhouse.html", "", -80), ("https://acme.io/open-position", "", 50), ("https://greenhouse.io.evil.com/", "Jobs", 30), ("https://u@JOBS.lever.co:443/a", "", 150), ("https://acme.io/", "Hiring", 0), (None, None, 0)]
    df = spark.createDataFrame(rows, "url string, label string, want int")
    assert [r.want for r in df.collect()] == [r.got for r in df.select(watchlist.candidate_score(F.col("url"), F.col("label")).alias("got")).collect()]
    assert watchlist.best_link(df.withColumn("g", F.lit(1)).where("want <= 0"), "g", watchlist.candidate_score(F.col("url"), F.col("label")), "url").isEmpty()


@pytest.mark.parametrize("target,base,same", [
    ("https://a.io/x", "https://A.io/y", True), ("https://a.io:443/x", "https://a.io/y", False), ("https://a.io:99999/x", "https://a.io:99999/y", False), ("https://me@a.io/", "https://a.io/", False), ("https://localhost/x", "https://localhost/", False),
    ("https://a.localhost/", "https://a.localhost/", False), ("https://192.168.1.9/", "https://192.168.1.9/", False), ("https://8.8.8.8/", "https://8.8.8.8/", True), ("https://192.0.0.9/", "https://192.0.0.9/", True), ("https://100.64.0.1/", "https://100.64.0.1/", False),
    ("https://[fe80::1]/", "https://[fe80::1]/", False), ("https://[2606:4700::1]/", "https://[2606:4700::1]/", True), ("https://[2001:db8::1]/", "https://[2001:db8::1]/", False), ("https://8.8.8.300/", "https://8.8.8.300/", True), (None, "https://a.io/", False), ("https:///x", "https:///x", False),
])
def test_same_origin(spark, target, base, same):
    df = spark.createDataFrame([(target, base)], "t string, b string")
    assert df.select(C.same_origin(F.col("t"), F.col("b")).alias("x")).first().x is same


def test_catalogue_fills_and_replaces(spark):
    fields = "slug string, name string, site_url string, vacancies_url string, vacancy_count long"
    stored = spark.createDataFrame([("A ", "Old", "https://own", None, 3), ("b", None, None, "https://v", None), ("", "x", None, None, 1)], fields)
    fresh = spark.createDataFrame([("a", "New", "https://fresh", "https://f", None, 1), ("B", "", "https://b", None, 0, 2), ("c", "C", None, None, None, 3), ("C", "C", "https://c", None, 0, 4), ("c", "C", "https://late", None, None, 5)], fields + ", seq long")
    merged = watchlist.merge_catalog(stored, fresh)
    got = {r.slug: (r.name, r.site_url, r.vacancies_url, r.vacancy_count) for r in merged.collect()}
    page = "https://jobs.dou.ua/companies/{}/vacancies/"
    assert got == {"a": ("New", "https://own", page.format("a"), 3), "b": ("b", "https://b", "https://v", 0), "c": ("C", "https://c", page.format("c"), 0)}
    assert tuple(watchlist.catalog_stats(merged).first()) == (1, 3, 1, 3)


def test_every_character_reference(spark):
    texts = [f"&{n}" for n in html5] + [f"x&{n}y&{n};z" for n in html5]
    texts += [f"&#{n};" for n in (*range(170), 8217, 0xD800, 0xFDD0, 0xFFFE, 0x1F600, 0x10FFFF, 0x110000, 0x1FFFE, 10**20)] + [f"&#x{n:X}" for n in (0, 38, 0x80, 0xD800, 0x1F600, 0x110000, 16**9)]
    texts += ["&", "&&amp;amp;", "&;", "a&b", "&#;", "&#x;", "", "&#0000000000038;", "& amp;", "&notit;", "&" + "a" * 40 + ";", "&amp;lt;", "&é;", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unescape(F.col("t")).alias("u")).collect()
    assert [(r.t, r.u) for r in rows if r.u != (html.unescape(r.t) if r.t is not None else None)] == []


def test_a_batch_of_a_channel_opens_the_files_that_it_lies_in(spark, tmp_path):
    """Every batch went through all captured messages, so that a stream's work grew with their square."""
    path = str(tmp_path / "captured")
    for i in range(6):
        _captured(spark, path, [(ch, 10 * i + j, "x", None) for ch in ("a", "b") for j in range(10)])
    reader = channels.ChannelStream({"path": path, "position": str(tmp_path / "pos" / "offset.json"), "cursors": json.dumps({"a": 23, "gone": 4}), "catch_up": "4", "lookback": "12", "bots": "[]"})
    opened, ids = [], reader._ids
    reader._ids = lambda channel, file: (opened.append(channel), ids(channel, file))[1]
    end = reader.latestOffset()
    assert end == {"a": 27, "gone": 4, "b": 59} and opened == ["a"]
    ranges = [r for p in reader.partitions({"a": 23, "gone": 4}, end) for r in p.ranges]
    assert [(c, after, upto, len(files)) for c, after, upto, files in ranges] == [("a", 23, 27, 1), ("b", 47, 59, 2)]
    assert reader.latestOffset()["a"] == 31 and reader._first("b", 5, reader._index()["b"]) == -1
