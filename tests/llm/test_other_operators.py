"""Embeddings, URLs and preferences."""

import math
import random
import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from dimflow.llm import embeddings, preferences, urls
from dimflow.llm.embeddings import ShardIndex
from dimflow.llm.hnsw import Graph
from dimflow.llm.queries import QUERIES, URL_RULES

# embeddings


def clustered(rng, groups, size, n, d=16):
    centres = rng.normal(size=(groups, d))
    near = centres[rng.integers(0, groups, size)] + rng.normal(size=(size, d)) * 0.03
    return np.concatenate([near, rng.normal(size=(n, d))])


def slow_links(vectors, threshold):
    usable = [
        v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for v in vectors
    ]
    n = len(vectors)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if usable[i] and usable[j] and len(vectors[i]) == len(vectors[j]):
                a, b = (np.array(v, float) / max(map(abs, v)) for v in (vectors[i], vectors[j]))
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    low, high = sorted((find(i), find(j)))
                    root[high] = low
    return links, [find(i) for i in range(n)]


def test_links_and_components(spark, held):
    rng = np.random.default_rng(1)
    vectors = clustered(rng, 6, 90, 120).tolist()
    vectors += [vectors[0]] * 4 + [[2 * x for x in vectors[1]]]
    vectors += [None, [], [0.0] * 16, [None] * 16, [math.nan] * 16, [math.inf] + [1.0] * 15]
    vectors += [[1.0, 0.0], [1.0, 0.1], [1e-320] * 16, [1e300] * 16]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>")
    table = table.withColumn("node", F.lit("clash")).withColumn("packed", F.lit(1)).repartition(3)
    rows = {r["key"]: r for r in embeddings.near_duplicates(table, held, 0.95).collect()}
    links, roots = slow_links(vectors, 0.95)
    assert [rows[i]["n_links"] for i in range(len(vectors))] == links
    assert [rows[i]["component"] for i in range(len(vectors))] == roots


def test_graph_search_against_a_scan():
    rng = np.random.default_rng(2)
    vectors = clustered(rng, 12, 1500, 2500, 32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    n = len(vectors)
    raw = Graph.build(vectors).to_bytes()
    index = ShardIndex(
        {"nodes": list(range(n)), "counts": [1] * n, "vectors": vectors.tobytes(), "graph": raw}
    )
    queries = np.concatenate([vectors[:300], vectors[-300:]])
    rows, places = index.links(queries, 0.95)
    true_rows, true_places = index.scan(queries, 0.95)
    found, true = {*zip(rows, places, strict=True)}, {*zip(true_rows, true_places, strict=True)}
    assert found <= true and len(found) >= 0.98 * len(true)
    ids, _ = index.graph.search(queries.astype(np.float32), 32)
    nearest = np.argsort(-(queries @ vectors.T), axis=1)[:, :10]
    recall = np.mean([len({*a} & {*b}) / 10 for a, b in zip(nearest.tolist(), ids.tolist(), strict=True)])
    assert recall >= 0.9


def test_links_of_a_large_group_in_bounded_memory():
    """A million pairs of 64 dimensions: 0.5 GB a side if they are gathered at once."""
    rng = np.random.default_rng(5)
    group = rng.normal(size=64) + rng.normal(size=(2000, 64)) * 0.03
    vectors = np.concatenate([group, rng.normal(size=(400, 64))])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    n = len(vectors)
    raw = Graph.build(vectors).to_bytes()
    index = ShardIndex(
        {"nodes": list(range(n)), "counts": [1] * n, "vectors": vectors.tobytes(), "graph": raw}
    )
    tracemalloc.start()
    rows, places = index.links(vectors[:512], 0.95)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    true = index.scan(vectors[:512], 0.95)
    assert len(true[0]) == 512 * 2000
    assert {*zip(rows.tolist(), places.tolist())} == {*zip(true[0].tolist(), true[1].tolist())}
    assert peak < 300e6


def test_every_shard_is_searched_by_graph(spark, held, monkeypatch):
    """Four shards of some 1,000 vectors: links by beams, and counts that agree with a
    scan of all; what one end misses is credited from the other."""
    rng = np.random.default_rng(9)
    vectors = clustered(rng, 400, 2400, 1700, 24)
    table = spark.createDataFrame(
        [(i, v) for i, v in enumerate(vectors.tolist())], "vec_id bigint, embedding array<double>"
    ).repartition(4)
    seen = []
    keep = held.keep

    def watched(df, **options):
        seen.append(keep(df, **options))
        return seen[-1]

    monkeypatch.setattr(held, "keep", watched)
    monkeypatch.setattr(embeddings, "LEAST_VECTORS", 1000)
    rows = {r["key"]: r for r in embeddings.near_duplicates(table, held, 0.95).collect()}
    found = next(d for d in seen if d.columns == ["kind", "a", "b", "n"])
    kinds = dict(found.groupBy("kind").count().collect())
    assert kinds.get(embeddings.SCANNED, 0) == 0 and kinds[embeddings.PAIR] > 2000
    graphs = next(d for d in seen if "graph" in d.columns)
    assert graphs.count() == 4
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    true = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    got = np.array([rows[i]["n_links"] for i in range(len(vectors))])
    assert got.sum() >= 0.99 * true.sum() and (got <= true).all()
    assert got.sum() % 2 == 0  # every link counts at both ends


def test_a_link_missed_at_one_end_is_credited(spark):
    kinds = [
        (embeddings.PAIR, 1, 2, None), (embeddings.PAIR, 2, 1, None),  # found from both
        (embeddings.PAIR, 1, 3, None),  # missed by 3
        (embeddings.PAIR, 4, 5, None),  # 5 was answered by a scan in the shard of 4
        (embeddings.PAIR, 6, 6, None),
    ]
    shard = spark.range(7).select(embeddings.shard_of(F.col("id"), 3)).collect()
    kinds.append((embeddings.SCANNED, 5, shard[4][0], None))
    kinds.append((embeddings.SCANNED, 3, 1 + max(r[0] for r in shard), None))
    found = spark.createDataFrame(kinds, embeddings.LINKS)
    nodes = spark.createDataFrame([(i, 10 + i) for i in range(7)], "node bigint, copies bigint")
    assert embeddings.missed_links(found, nodes, 3).collect() == [(3, 11)]


def test_runs_fold_to_counts_and_a_forest():
    rng = np.random.default_rng(6)
    for _ in range(60):
        nodes = rng.permutation(60)[:40]
        ids = rng.permutation(60)[:25]
        counts = rng.integers(1, 4, 40)
        links = np.argwhere(rng.random((25, 40)) < rng.choice([0.02, 0.05, 0.4]))
        fold = embeddings.Fold(ids, nodes, counts)
        for run in np.array_split(rng.permutation(links), 5):
            fold.add(run[:, 0], run[:, 1])
        pairs = [(ids[i], nodes[j], counts[j]) for i, j in links if ids[i] != nodes[j]]
        for i, x in enumerate(ids):
            assert fold.found[i] == sum(c for a, _, c in pairs if a == x)

        def groups(edges):
            root = list(range(60))
            for a, b in edges:
                root = [root[b] if r == root[a] else r for r in root]
            return {frozenset(i for i in range(60) if root[i] == r) for r in root}

        kept = list(zip(fold.left, fold.right, strict=True))
        assert groups(kept) == groups([(a, b) for a, b, _ in pairs])
        assert len(kept) == 60 - len(groups(kept))


def test_embeddings_of_an_empty_table_and_repeated_keys(spark, held):
    shape = "vec_id bigint, embedding array<float>"
    assert embeddings.near_duplicates(spark.createDataFrame([], shape), held).count() == 0
    table = spark.createDataFrame([(3, [1.0, 0.0]), (3, [0.0, 1.0]), (None, [1.0, 0.0])], shape)
    rows = embeddings.near_duplicates(table, held).collect()
    assert sorted((r["n_links"], r["component"]) for r in rows) == [(0, 3), (1, 3), (1, 3)]


# URLs


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_hosts_paths_and_rules(spark, held):
    rows = [
        (0, "https://WWW.Example.ORG/es/1?q=/x#y", None),
        (1, "http://example.org/en/12", ""),
        (2, "http://notexample.org/es/", ""),
        (3, "http://a.com/fr/x://y", ""),
        (4, "http://a.com?/fr/", ""),
        (5, "no scheme", ""),
        (6, None, ""),
        (7, "x://h#f", ""),
        (7, "x://h#f", ""),
    ]
    table = pages(spark, rows).withColumn("host", F.lit("clash"))
    found = urls.judge(table, URL_RULES, held).collect()
    got = sorted((r["key"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found)
    assert got[0] == (0, "www.example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == (1, "example.org", "/en/12", "example.org/en/1", "block")
    assert got[2][3:] == ("org/", "allow")
    assert got[3] == (3, "a.com", "/fr/x://y", "com/fr/", "allow")
    assert got[4] == (4, "a.com", "", None, "allow")
    assert got[5][1:] == ("", "", None, "allow") and got[6][1:] == ("", "", None, "allow")
    assert len(got) == 9 and got[7] == got[8]


def link_pages():
    rng = random.Random(3)
    hosts = [f"h{i}.{x}" for i in range(12) for x in ("com", "net", "org")]
    rows = []
    for i in range(400):
        host = rng.choice(hosts)
        links = [f"http://{rng.choice(hosts)}/p", f"//{rng.choice(hosts)}", "/own", "#top"]
        html = "".join(f"<a class=x HREF='{x}'>t</a>" for x in rng.sample(links, 2))
        rows.append((i, f"http://{host}/{rng.choice(['fr', 'de', 'en'])}/{i}", html))
    rows += [(i, f"http://spam.com/de/{i}", "") for i in range(400, 430)]
    rows += [(i, f"http://feeds{i}.net/", "<a href=//spam.com/>x</a>") for i in range(430, 440)]
    return rows


def test_trust_spreads_as_in_sql(spark, held, monkeypatch):
    monkeypatch.setattr(urls, "TOLERANCE", 0.05)  # some 40 rounds, as in SQL
    table = pages(spark, link_pages())
    db = duckdb.connect()
    db.register("pages", table.toPandas())
    want = db.execute(urls.judge_sql(URL_RULES)).fetchall()
    got = [tuple(r) for r in urls.judge(table, URL_RULES, held).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_scores_by_hand(spark, held, monkeypatch):
    monkeypatch.setattr(urls, "TOLERANCE", 0)
    seeds = spark.createDataFrame([("a", 0, 1000), ("c", 1, 1000)], "host string, kind int, score bigint")
    links = spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string")
    scores = {(r["host"], r["kind"]): r["score"] for r in urls.spread(seeds, links, held).collect()}
    assert scores == {
        ("a", 0): 150, ("b", 0): 127, ("c", 0): 107, ("c", 1): 150, ("b", 1): 127, ("a", 1): 107,
    }


def test_scores_reach_over_high_degrees(spark, held):
    """Distrust of one blocked page over degrees of 1,000 and then 127, then 50."""
    rows = [(0, "http://spam.com/de/0", "")]
    for i in range(1000):
        rows.append((1 + i, f"http://a{i}.net/", "<a href=//spam.com/>x</a>"))
    for i in range(127):
        rows.append((2000 + i, f"http://b{i}.net/", "<a href=//a0.net/>x</a>"))
    for i in range(50):
        rows.append((3000 + i, f"http://c{i}.net/", "<a href=//b0.net/>x</a>"))
    found = {r["host"]: r["verdict"] for r in urls.judge(pages(spark, rows), URL_RULES, held).collect()}
    assert len(found) == 1 + 1000 + 127 + 50 and set(found.values()) == {"block"}


def test_a_long_chain_is_decided(spark, held):
    """Forty links from a blocked page."""
    rows = [(0, "http://h0.com/de/0", "")]
    rows += [(i, f"http://h{i}.net/", f"<a href=//h{i - 1}.{'com' if i == 1 else 'net'}/>x</a>") for i in range(1, 42)]
    found = {r["host"]: r["verdict"] for r in urls.judge(pages(spark, rows), URL_RULES, held).collect()}
    assert set(found.values()) == {"block"} and len(found) == 42


def test_cycles_come_to_rest(spark, held, monkeypatch):
    monkeypatch.setattr(urls, "TOLERANCE", 1e-3)
    seeds = spark.createDataFrame([("a", 0, str(urls.FINE))], "host string, kind int, score string")
    links = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "a string, b string")
    found = {r["host"]: float(r["score"]) / urls.FINE for r in urls.spread(seeds, links, held).collect()}
    a = 0.15 / (1 - 0.85 * 0.85 / 2)
    assert found["a"] == pytest.approx(a, abs=6e-3) and found["b"] == pytest.approx(0.85 * a, abs=6e-3)
    monkeypatch.setattr(urls, "MOST_ROUNDS", 3)
    with pytest.raises(RuntimeError, match="still grow"):
        urls.spread(seeds, links, held)


def test_the_longest_rule_and_ties(spark, held):
    rules = [urls.Rule("block", "a.com", "/xy"), urls.Rule("allow", "xa.com", "/x"), urls.Rule("block", "com", "/x")]
    html = "<a href='http://b.org/'>t</a>" * 40_000
    rows = [(0, "http://xa.com/xyz", html), (1, "http://b.a.com/xyz", None), (2, "http://q.com/x", "")]
    rules += [urls.Rule("allow", "q.com", ""), urls.Rule("block", "q.co", "m")]
    found = {r["key"]: (r["rule"], r["verdict"]) for r in urls.judge(pages(spark, rows), rules, held).collect()}
    assert found == {0: ("xa.com/x", "allow"), 1: ("a.com/xy", "block"), 2: ("com/x", "block")}


def test_scores_of_many_pages_do_not_overflow(spark, held):
    seed = urls.FINE * 10**11
    seeds = spark.createDataFrame([("a", 0, str(seed))], "host string, kind int, score string")
    links = spark.createDataFrame([("a", "b"), ("a", "c")], "a string, b string")
    scores = {r["host"]: int(r["score"]) for r in urls.spread(seeds, links, held).collect()}
    start = seed * 15 // 100
    assert scores == {"a": start, "b": start * 85 // 200, "c": start * 85 // 200}


def test_urls_of_an_empty_table(spark, held):
    assert urls.judge(pages(spark, []), URL_RULES, held).count() == 0


# preferences


def turns(*texts):
    return [("user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


def test_common_prefix_is_rendered_once(spark):
    cases = [
        (0, turns("q", "a", "q2", "good"), turns("q", "a", "q2", "bad")),
        (1, turns("q", "a"), turns("q", "a")),
        (2, turns("q", "a"), turns("q")),
        (3, None, turns("q", "a")),
        (4, [], []),
        (5, turns("q", None), turns("q", None, "r")),
        (6, [(None, "<|end|>")], turns("x")),
    ]
    shape = "array<struct<role:string,text:string>>"
    table = spark.createDataFrame(cases, f"id bigint, c {shape}, r {shape}").withColumn("prompt", F.lit(1))
    rows = {r["key"]: r for r in preferences.format_pairs(table, "id", "c", "r").collect()}
    assert [rows[i]["common"] for i in range(7)] == [3, 2, 1, 0, 0, 2, 0]
    assert rows[0]["prompt"] == "<|user|>\nq<|end|>\n<|assistant|>\na<|end|>\n<|user|>\nq2<|end|>\n"
    assert [tuple(s) for s in rows[0]["chosen"]] == [("<|assistant|>\n", False), ("good<|end|>\n", True)]
    assert [s["train"] for s in rows[5]["rejected"]] == [False, False]
    assert rows[1]["chosen"] == rows[1]["rejected"] == []
    assert rows[6]["chosen"][1]["text"] == "< |end|><|end|>\n"


def test_reply_pairs(spark):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "q"), (1, 3, "assistant", "b"),
        (1, 4, "user", "late"), (2, 1, "assistant", None), (2, 0, "user", "q"), (3, 0, "user", "q"),
        (None, 0, "assistant", "x"), (None, 0, "assistant", "x"),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = preferences.reply_pairs(table.withColumn("said", F.lit(1))).collect()
    by_key = {(r["key"], r["changed"]): r for r in found if r["key"] is not None}
    assert set(by_key) == {(1, 4), (1, 2), (2, 2), (3, None)}
    assert [t["text"] for t in by_key[1, 4]["chosen"]] == ["q", "a", "q", "b", "late"]
    assert [t["text"] for t in by_key[1, 4]["rejected"]] == ["q", "a", "q", "a", "late"]
    assert [t["text"] for t in by_key[1, 2]["rejected"]] == ["q", "b", "q", "b", "late"]
    assert [t["text"] for t in by_key[2, 2]["rejected"]] == ["q", ""]
    assert by_key[3, None]["chosen"] == by_key[3, None]["rejected"]
    assert sum(r["key"] is None for r in found) == 2
    assert preferences.reply_pairs(table.limit(0)).count() == 0


def test_an_early_difference_is_found(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i // 4}") for i in range(12)]
    rows += [(2, i, "assistant" if i % 2 else "user", "same") for i in range(4)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pairs = preferences.reply_pairs(table)
    formed = preferences.format_pairs(pairs, "key", "chosen", "rejected", carried=("changed",))
    found = {(r["key"], r["changed"]): r for r in formed.collect()}
    # the first two replies say the same, so that pair has no difference; the last differs
    assert [(k, r["common"]) for k, r in sorted(found.items())] == [
        ((1, 2), 12), ((1, 12), 12), ((2, 2), 4), ((2, 4), 4),
    ]
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(12)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    pairs = preferences.reply_pairs(table)
    formed = preferences.format_pairs(pairs, "key", "chosen", "rejected", carried=("changed",))
    found = {r["changed"]: r for r in formed.collect()}
    assert found[2]["common"] == 1 and found[12]["common"] == 11
    assert found[2]["prompt"] == "<|user|>\nt0<|end|>\n"
    assert len(found[2]["chosen"]) == 22 and found[2]["rejected"][1]["text"] == "t3<|end|>\n"
    assert [s["text"] for s in found[2]["chosen"][2:]] == [s["text"] for s in found[2]["rejected"][2:]]


def test_ties_of_turns_and_very_long_ones(spark):
    long = "word " * 400_000
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "c"), (1, None, "user", "first"),
            (1, 1, "assistant", long)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {r["changed"]: r for r in preferences.reply_pairs(table).collect()}
    assert [t["text"] for t in found[5]["chosen"]] == ["first", "c", "a", "b", long]
    assert found[2]["rejected"][1]["text"] == long and found[5]["rejected"][4]["text"] == "c"


def test_registered_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
