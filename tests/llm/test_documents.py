"""Fingerprints, quality, shards, near groups, leaks, tool calls and the pipeline against plain versions."""

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from check_oracle import compare, connect
from llm import brute
from llm.conftest import prose
from stockpond.llm import components, decontaminate, fingerprints, gray_index, native, quality, shards, tool_calls
from stockpond.llm.registry import ORACLES

U64 = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


# Fingerprints


def test_edited_texts(spark, mixed, none):
    rows = fingerprints.edited_fingerprints(mixed).collect()
    assert len(rows) == mixed.count()
    docs = mixed.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    docs.sort(key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.h))
    want = Counter()
    for i, r in enumerate(docs):
        after, half = docs[(i + 1) % len(docs)].t, len(r.t) // 2
        want[r.doc_id, len(r.t), brute.sha(r.t[: len(r.t) - half] + after[:half])] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    one = {r.t: None for r in docs}
    assert len({r.fingerprint for r in rows}) <= len(one)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert {r.fingerprint for r in rows if r.n_chars == 0} == {0}
    assert fingerprints.edited_fingerprints(none).count() == 0


def test_one_document_follows_itself(spark):
    row = fingerprints.edited_fingerprints(spark.createDataFrame([(5, "one two three four")], "doc_id bigint, text string")).first()
    assert row.near_next == 1.0 and row.edited_sha256 == brute.sha("one two t" + "one two t")


def test_votes_give_signed_bits(spark):
    text = prose(1, 40)
    pairs = brute.words(text)
    terms = spark.createDataFrame([(a, b, min(len(a), len(b))) for a, b in zip(pairs, pairs[1:])], "a string, b string, w int").select(F.xxhash64("a", "b").alias("h"), "w").collect()
    want = sum(1 << b for b in range(64) if sum(t.w if (t.h & U64) >> b & 1 else -t.w for t in terms) > 0)
    got = fingerprints.fingerprints(spark.createDataFrame([(1, text)], "k int, text string"), ["k"], "text").first()
    assert got.fingerprint & U64 == want


def test_block_tables_find_all_in_radius(spark):
    draw = random.Random(2)
    centres = [draw.getrandbits(64) for _ in range(6)]
    prints = [c ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(7))) for c in centres for _ in range(40)] + [0, U64, 1 << 63]
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint bigint")
    asked = frame.limit(50)
    want = {(a, b) for a in {r.fingerprint for r in asked.collect()} for b in {signed(p) for p in prints} if ((a ^ b) & U64).bit_count() <= 3}
    assert {tuple(r) for r in fingerprints.within_radius(frame, asked).collect()} == want


# Near groups


@pytest.mark.parametrize("seed", range(4))
def test_gray_index_links_what_brute_force_links(seed):
    draw = random.Random(seed)
    prints = {0, U64}
    for _ in range(12):
        p = draw.getrandbits(64)
        for _ in range(40):
            p ^= sum(1 << b for b in draw.sample(range(64), draw.randrange(6)))
            prints.add(p)
    prints = sorted(prints, key=lambda p: int.from_bytes(_rank(p).to_bytes(8, "big"), "big"))
    labels = gray_index.GrayIndex(np.zeros(len(prints), np.int64), np.array(prints, np.uint64)).groups(4)
    assert labels.tolist() == brute.components(prints, 4)


def _rank(p):
    for step in (1, 2, 4, 8, 16, 32):
        p ^= p >> step
    return p


def test_work_in_small_runs(monkeypatch):
    monkeypatch.setattr(gray_index, "PAIRS_AT_ONCE", 3)
    draw = random.Random(9)
    prints = sorted({draw.getrandbits(12) for _ in range(60)}, key=_rank)
    upper = np.arange(len(prints)) // 20
    labels = gray_index.GrayIndex(upper, np.array(prints, np.uint64)).groups(2)
    for g in range(upper.max() + 1):
        part = [i for i in range(len(prints)) if upper[i] == g]
        assert [labels[i] - part[0] for i in part] == brute.components([prints[i] for i in part], 2)


def test_gray_rank_sorts_like_the_sequence(spark):
    values = [0, 1, 3, 2, 6, 7, 5, 4, 12, 1 << 63]
    frame = spark.createDataFrame([(signed(v),) for v in values], "p bigint")
    ranked = [r.p & U64 for r in frame.orderBy(gray_index.gray_rank(F.col("p"))).collect()]
    assert ranked == sorted(values, key=_rank) and ranked[:9] == values[:9]


def test_near_groups(spark, mixed, none):
    draw, base = random.Random(4), prose(70, 400).split(" ")
    texts = [r.text for r in mixed.select("text").collect()]
    near = []
    for _ in range(40):
        words = list(base)
        words[draw.randrange(len(words))] = draw.choice(["alpha", "beta", "gamma"])
        near.append(" ".join(words))
    rows = [(i, t) for i, t in enumerate(texts + near)]
    found = {r.doc_id: r for r in gray_index.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    prints = [brute.print_of(t) for _, t in rows]
    assert [found[i].fingerprint & U64 for i in range(len(rows))] == prints
    assert [found[i].component_id for i in range(len(rows))] == brute.components(prints, 4)
    again = gray_index.near_groups(mixed).collect()
    assert len(again) == mixed.count() and gray_index.near_groups(none).count() == 0


def test_one_row_of_each_group_stays(spark, mixed, none):
    kept = gray_index.one_of_each(mixed)
    assert kept.columns == mixed.columns and gray_index.one_of_each(none).count() == 0
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda i: (i is None, i or 0))
    prints = {}
    for r in mixed.collect():
        prints.setdefault(brute.print_of(r.text), []).append(r.doc_id)
    want = sorted(min((i for i in group if i is not None), default=None) for group in prints.values())
    assert ids == want
    nulls = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None)], "doc_id bigint, text string")
    assert sorted(r.text or "" for r in gray_index.one_of_each(nulls).collect()) == ["", "a b"]


def test_components(spark):
    draw = random.Random(5)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(5001, 5100)] + [(7, 7)]
    group = {}
    for a, b in pairs:
        group.setdefault(a, a), group.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {n: group[n] for n in linked}
    assert components.connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Quality


def test_ranking_of_held_out_rows(spark, sf_dir):
    rows = entry_points.queries()["op5_quality_ranking"](spark, sf_dir).toPandas()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert rows.held_out.tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.7) == (rows.predicted == 1)).all()
    known = rows.merge(labels, on="doc_id")
    known = known[known.held_out]
    assert (known.predicted == known.quality).mean() > 0.95


def test_labels_with_gaps(spark, mixed, none):
    docs = spark.createDataFrame([(i, prose(i, 80) if i % 2 else "BUY!! NOW!! $$$ " * 20) for i in range(60)], "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")).unionByName(spark.createDataFrame([(None, 1), (3, None), (1, 1), (999, 0)], "doc_id bigint, quality int"))
    ranking = quality.learn(docs, labels)
    assert {r.doc_id % 2 for r in quality.accepted(docs, ranking).collect()} == {1}
    scores = quality.scored(mixed, ranking)
    assert scores.count() == mixed.count() and scores.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    for empty in (labels.limit(0), labels.where("quality = 1")):
        assert quality.accepted(docs, quality.learn(docs, empty)).count() == 60
    assert quality.scored(none, ranking).count() == 0 and quality.learn(none, labels).weights == (0.0,) * len(quality.FEATURES)


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(40)], "doc_id bigint, text string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    rows = quality.labelled_sample(docs, labels).count()
    assert rows == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(40))


def test_all_labelled_rows_are_learned(spark):
    rows = [(i, i % 3 == 0, [float(i % 3 == 0), float(i)] + [0.0] * (len(quality.FEATURES) - 2)) for i in range(41_000) if zlib.crc32(str(i).encode()) % 4 != 2]
    features = spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id bigint, features array<double>")
    labels = spark.createDataFrame([(i, int(good)) for i, good, _ in rows], "doc_id bigint, quality int")
    assert quality.labelled_rows(features, labels).count() == len(rows) > 30_000
    assert sum(not good for _, good, _ in rows) > 20_000
    ranking = quality.learn_described(features, labels)
    raw = {which: sorted(sum(w * v for w, v in zip(ranking.weights, x)) for _, good, x in rows if good == which) for which in (True, False)}
    edges = np.quantile(raw[True], quality.EDGE), np.quantile(raw[False], 1 - quality.EDGE)
    assert ranking.cut == pytest.approx(sum(edges) / 2, rel=1e-9) and ranking.weights[0] > 0


def test_pairs_of_all_labelled_rows(spark, monkeypatch):
    seen = []
    plain = quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda df, name: seen.append((name, plain(df, name))) or seen[-1][1])
    docs = spark.createDataFrame([(i, "a1 " * (i + 1)) for i in range(60)], "doc_id bigint, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("quality"))
    quality.learn(docs, labels)
    tables = dict(seen)
    n = {r.good: r["count"] for r in tables["labelled-rows"].groupBy("good").count().collect()}
    assert tables["preferences"].count() == max(n.values()) * quality.PARTNERS
    assert n[True] + n[False] == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(60))


# Shards


def test_schedule_like_a_plain_one(spark, mixed, none):
    rows = shards.with_shards(mixed, 4).collect()
    texts = [r.text or "" for r in mixed.collect()]
    sizes = Counter()
    for t in texts:
        sizes[hashlib.md5(t.encode()).hexdigest()] += len(t.encode()) + 1
    loads, want = [0] * 4, {}
    for group, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if size * shards.SINGLES < sum(sizes.values()):
            continue
        want[group] = loads.index(min(loads))
        loads[want[group]] += size
    placed = {(r.text_crc32, r.size): r.shard for r in rows}
    for t in texts:
        group = hashlib.md5(t.encode()).hexdigest()
        assert group not in want or placed[zlib.crc32(t.encode()), len(t.encode()) + 1] == want[group]
    assert len(rows) == len(texts)
    for shard in range(4):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert shards.with_shards(none).count() == 0


def test_shards_are_even_and_groups_whole(spark, monkeypatch):
    monkeypatch.setattr(shards, "SINGLES", 64)
    monkeypatch.setattr(shards, "BUNDLES", 64)
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 700).cast("int")).alias("text"))
    rows = shards.with_shards(docs, 5).toPandas()
    loads = rows.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() < 0.1 * loads.mean()
    assert rows.groupby("text_crc32").shard.nunique().max() == 1


# Leaks


def test_leaks_like_brute_force(spark, mixed, none):
    items = [(i, prose(200 + i, 16 + 3 * i)) for i in range(8)] + [(8, "only four words here"), (9, None), (10, ""), (0, prose(200, 16))]
    texts = [prose(300 + i, 50) + "\n" + items[i][1].upper() + "! " + prose(400 + i, 30) for i in range(8)]
    cut = items[7][1].split(" ")
    texts += [" ".join(cut[:18]), " ".join([*cut[:5], "new", *cut[6:]]), "Only four, words HERE", prose(500, 200), None, "", items[3][1]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    want = {(d, i) for d, t in enumerate(texts) for i, item in items if brute.words(item) and brute.best_window(t, item) >= 0.8}
    assert found == want and len(want) == 10
    assert {r.doc_id for r in decontaminate.clean(docs, bench).collect()} == set(range(len(texts))) - {d for d, _ in want}
    clean = decontaminate.clean(mixed, bench)
    assert clean.count() == mixed.count() and clean.columns == mixed.columns
    assert decontaminate.clean(none, bench).count() == 0 and decontaminate.clean(docs, bench.limit(0)).count() == len(texts)


def test_bit_filter_holds_all_keys(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("k"))
    row = native.bit_filter(keys, "k")
    assert keys.where(native.may_hold(row, F.col("k"))).count() == 500
    others = spark.range(10_000, 30_000).select(F.xxhash64("id").alias("k"))
    assert others.where(native.may_hold(row, F.col("k"))).count() < 20


# Tool calls


def test_calls_are_linked_ordered_and_checked(spark):
    calls = [
        (1, "b", "find", '{"n": 2, "q":"x"}', ["a"]),
        (1, "a", "find", '{ "q" : "é\\n", "n":1.0, "n2":{"z":1,"a":[2, 1]}}', []),
        (1, "c", "find", '{"q":1,"n":"2"}', ["b", "a", "missing"]),
        (1, "d", "find", "[1]", ["e"]),
        (1, "e", "none", '{"q":"x","n":1}', ["d"]),
        (1, "f", "find", "{broken", ["d"]),
        (2, "a", "find", None, None),
        (2, "a", "find", '{"n":1}', []),
        (None, None, "find", '{"q":"x","n":3}', []),
    ]
    calls = spark.createDataFrame(calls, "conv_id bigint, call_id string, name string, arguments string, after array<string>").withColumn("level", F.lit("x"))
    results = spark.createDataFrame([(1, "a", "ok"), (1, "a", "later"), (2, "x", "lost"), (None, None, "n"), (1, "b", None)], "conv_id bigint, call_id string, content string")
    tools = spark.createDataFrame([("find", "q", "string", True), ("find", "n", "integer", True), ("find", "n2", "object", False)], "name string, param string, type string, required boolean")
    rows = {(r.conv_id, r.call_id): r for r in tool_calls.linked(calls, results, tools).collect()}
    assert {k: (r.position, r.level) for k, r in rows.items() if k[0] == 1} == {(1, "a"): (0, 0), (1, "b"): (1, 1), (1, "c"): (2, 2), (1, "d"): (3, None), (1, "e"): (4, None), (1, "f"): (5, None)}
    assert rows[1, "b"].valid and rows[None, None].valid and rows[None, None].n_results == 1
    # 1.0 is the whole number one.
    assert rows[1, "a"].errors in ([], ["argument n is no integer"]) and rows[1, "a"].n_results == 2
    assert rows[1, "c"].errors == ["argument n is no integer", "argument q is no string"]
    assert rows[1, "d"].errors == ["arguments are not an object", "waits for itself"] and "unknown tool" in rows[1, "e"].errors
    assert rows[1, "f"].errors == ["arguments are not an object", "waits for itself"] and rows[2, "a"].n_calls == 2
    assert rows[1, "a"].record == '{"arguments":{"n":1,"n2":{"a":[2,1],"z":1},"q":"é\\n"},"call_id":"a","conv_id":1,"name":"find","result":"later"}'
    assert json.loads(rows[1, "f"].record)["arguments"] == "{broken" and json.loads(rows[2, "a"].record)["result"] is None
    assert tool_calls.linked(calls.limit(0), results, tools).count() == 0


# Queries and pipeline


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, sf_dir, name):
    ok, message = compare(spark, connect(sf_dir), sf_dir, name)
    assert ok, message


def test_every_operator_has_a_query():
    names = entry_points.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    columns, before = docs.columns, docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, sf_dir)
        path = native.materialize(after, "test-stage")
        old, new = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in path.collect()}
        assert set(new) <= set(old) and len(new) == path.count()
        if number < 4:
            assert path.columns == columns and all(r.n_chars == len(r.text) for r in new.values())
        if name == "SimHash near-dedup":
            order = sorted(old)
            group = brute.components([brute.print_of(old[i].text) for i in order], 4)
            assert sorted(new) == sorted({order[g] for g in group})
        if name == "benchmark decontamination":
            leaking = {i for i, r in old.items() if any(brute.best_window(r.text, t) >= 0.8 for t in items if set(brute.words(t)[:8]) <= set(brute.words(r.text)))}
            assert set(old) - set(new) == leaking
        if number == 4:
            assert all(new[i].decoded_sha256 == brute.sha(old[i].text) for i in old)
        before = path
    assert set(new) == {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()}


def test_pipeline_without_rows(spark, sf_dir, none):
    docs = none.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = native.materialize(stage(spark, docs, sf_dir), "empty-stage")
    assert docs.count() == 0
