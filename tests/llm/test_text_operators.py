"""Quality rules, language, SimHash and repeated strings against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimflow.llm import langid, quality, simhash, suffixes
from dimflow.llm.components import components

WORDS = "the of and thing over under with from that this when where".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


# quality rules


def test_base_statistics():
    text = "A b c\nA b c\n\n A b  c\n# $x"
    n_words, chars, symbols, dups, repeated = quality.describe(text.encode())[:5]
    assert (n_words, chars, symbols, dups, repeated) == (11, 12, 2, 1, 9)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40))
def test_repeated_words(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    assert quality.repeated_words(words) == len(covered)


def test_frequent_lines_and_depleted_documents(spark, make_docs, held):
    rng = random.Random(1)
    notice = sentence(rng, 60)
    texts = [f"{notice}\n{sentence(rng, 20)}" for _ in range(40)]  # mostly notice
    texts += [f"{notice.upper()}\n{sentence(rng, 200)}" for _ in range(40)]  # partly
    texts += [sentence(rng, 80)] * 30  # copies of one clean document
    texts += [sentence(rng, 80) for _ in range(60)] + [None, "", "few words"]
    docs = make_docs(texts).withColumn("removed", F.lit("clash")).withColumn("hash", F.lit(1))
    rows = {r["key"]: r for r in quality.judge(docs, held).collect()}
    assert len(rows) == len(texts)
    assert rows[0]["kept"] and rows[0]["removed_words"] == 0  # its first holder keeps the line
    assert all(not rows[i]["kept"] and rows[i]["removed_words"] == 60 for i in range(1, 40))
    assert all(rows[i]["kept"] and rows[i]["removed_words"] == 60 for i in range(40, 80))
    assert all(rows[i]["kept"] and rows[i]["removed_words"] == 0 for i in range(80, 170))
    assert all(rows[i]["base_failed"] and not rows[i]["kept"] for i in range(170, 173))
    left = quality.without_lines(docs, quality.judge(docs, held), "text", "source").collect()
    assert len(left) == 131
    assert all(r["text"].count("\n") == 0 for r in left if 40 <= r["doc_id"] < 80)
    assert left[0].asDict().keys() == {*docs.columns}


def test_a_line_in_very_many_documents_goes_whatever_its_share(make_docs, held, monkeypatch):
    monkeypatch.setattr(quality, "MOST_DOCUMENTS", 30)
    own = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(4000)]
    texts = [f"{t}\nnotice of the host" if i < 40 else f"{t}\nrare" if i < 70 else t for i, t in enumerate(own)]
    rows = {r["key"]: r["removed_words"] for r in quality.judge(make_docs(texts), held).collect()}
    assert [rows[i] for i in (0, 1, 39)] == [0, 4, 4]  # 40 of 4,000 are a 100th, but over 30
    assert all(rows[i] == 0 for i in range(40, 4000))


def test_one_rule_of_white_space(make_docs, held):
    """A line of no-break spaces is a line of words; both counts and texts say so."""
    odd = "\xa0\xa0"
    texts = [f"{' '.join(f'w{i}x{j}' for j in range(60))}\n{odd}" for i in range(25)]
    docs = make_docs(texts)
    verdicts = held.keep(quality.judge(docs, held))
    assert sorted(r["removed_words"] for r in verdicts.collect()) == [0] + [1] * 24
    left = [r["text"] for r in quality.without_lines(docs, verdicts, "text", "source").collect()]
    assert sum(odd in t for t in left) == 1


def test_hosts_are_apart_and_nulls_share_one(make_docs, held):
    rng = random.Random(2)
    notice = sentence(rng, 60)
    texts = [f"{notice}\n{sentence(rng, 10)}" for _ in range(60)]
    docs = make_docs(texts, source=["a"] * 20 + ["b"] * 15 + [None] * 25)
    kept = {r["key"] for r in quality.judge(docs, held).filter("kept").collect()}
    assert kept == {*range(36)}


def test_quality_of_an_empty_table(make_docs, held):
    assert quality.judge(make_docs([]), held).count() == 0


# language


def language(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n))


def test_language_of_held_out_texts(spark, make_docs):
    rng = random.Random(3)
    kinds = {"xx": "aeioulmn", "yy": "aeioukzt", "zz": "äöüßschn"}
    names = [rng.choice([*kinds]) for _ in range(300)]
    texts = [language(rng, kinds[n], 40) for n in names]
    docs = make_docs(texts, lang=names).withColumn("score", F.lit("clash"))
    model = langid.train(docs.filter(~langid.held_out("doc_id")), "text", "lang")
    rows = langid.predict(docs, model).collect()
    tested = [r for r in rows if r["key"] % 1 == 0]
    assert sum(r["lang_pred"] == names[r["key"]] for r in tested) >= 0.99 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_copies_do_not_thin_the_sample(spark):
    few = F.format_string("only %s", F.col("id") % 50)
    many = F.when(F.col("id") < 90_000, F.lit("copied")).otherwise(F.format_string("own %s", "id"))
    rows = spark.range(100_000)
    table = rows.select(F.lit("few").alias("lang"), few.alias("text")).unionByName(
        rows.select(F.lit("many").alias("lang"), many.alias("text"))
    )
    found = langid.sample_per_language(table).groupBy("lang").agg(F.countDistinct("text"), F.count("*"))
    assert sorted(map(tuple, found.collect())) == [("few", 50, 50), ("many", 1000, 1000)]


def slow_bits(model_counts, text, language):
    """Code length by walking the contexts of one language."""
    counts, total = model_counts, 0.0
    padded = b" " * langid.ORDER + text
    for i in range(langid.ORDER, len(padded)):
        for k in range(langid.ORDER, -2, -1):
            if k < 0:
                total += 8
                break
            context, byte = padded[i - k : i], padded[i]
            seen = counts[language][k].get(context)
            if seen is None:
                continue
            size = sum(seen.values()) + len(seen)
            if byte in seen:
                total -= np.log2(seen[byte] / size)
                break
            total -= np.log2(len(seen) / size)
    return total


def test_code_lengths_are_exact():
    rng = random.Random(4)
    training = {"p": [b"abracadabra abba"], "q": [b"banana bandana", b"nab"]}
    counts = {x: [defaultdict(lambda: defaultdict(int)) for _ in range(4)] for x in training}
    arrays = {k: ([], [], []) for k in range(4)}
    for n, (name, texts) in enumerate(training.items()):
        for window in langid.text_windows(texts).tolist():
            raw = window.to_bytes(4, "big")
            for k in range(4):
                counts[name][k][raw[3 - k : 3]][raw[3]] += 1
                for column, value in zip(arrays[k], (window & ((1 << 8 * (k + 1)) - 1), n, 1), strict=True):
                    column.append(value)
    model = langid.Model([*training], {k: tuple(map(np.array, v)) for k, v in arrays.items()})
    texts = [bytes(rng.choice(b"abndr cx") for _ in range(rng.randrange(30))) for _ in range(50)]
    bits = model.bits(texts)
    for text, row in zip(texts, bits, strict=True):
        for n, name in enumerate(training):
            assert row[n] == pytest.approx(slow_bits(counts, text, name), abs=1e-3)


def test_unknown_texts(make_docs):
    docs = make_docs(["abc abc", None, "", "123 .!", "é"], lang=["a", None, "b", "b", None])
    model = langid.train(docs, "text", "lang")
    found = {r["key"]: r["lang_pred"] for r in langid.predict(docs, model).collect()}
    assert [found[i] for i in (1, 2, 3)] == ["und"] * 3 and found[0] in ("a", "b")
    nothing = langid.train(make_docs([]), "text", "lang")
    assert {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(make_docs([]), model).count() == 0


def prose_model(spark, make_docs):
    rng = random.Random(5)
    kinds = {"xx": "aeioulmn", "yy": "aeioukzt"}
    names = [rng.choice([*kinds]) for _ in range(400)]
    texts = [language(rng, kinds[n], 60) for n in names]
    return rng, kinds, langid.train(make_docs(texts, lang=names), "text", "lang")


def test_score_tells_prose_from_junk_and_other_scripts(spark, make_docs):
    rng, kinds, model = prose_model(spark, make_docs)
    clean = [language(rng, letters, n) for letters in kinds.values() for n in (10, 60, 2000)]
    junk = [
        language(rng, "#$%&*^@|~q", 60), language(rng, "BCDFGHJKLM", 60), language(rng, "0123456789abcdef", 60),
        language(rng, "абвгдежзик", 60), language(rng, "日本語文字列", 60), language(rng, "bcdfghjpqrsvwxy", 60),
    ]
    names, scores = langid.classify(model, clean + junk)
    assert names[:6] == ["xx"] * 3 + ["yy"] * 3
    assert min(scores[:6]) > 0.8 and max(scores[6:]) < 0.5
    assert all(0 <= s <= 1 for s in scores)


def test_one_long_text_scores_as_its_parts(spark, make_docs):
    """A text longer than a scoring step is scored whole."""
    rng, kinds, model = prose_model(spark, make_docs)
    text = language(rng, kinds["xx"], 400_000)
    assert len(text) > langid.STEP
    (alone,) = model.bits([text.encode()])
    before, after = model.bits([text[:1_000_000].encode(), text[999_997:].encode()])
    seam = model.bits([text[999_997:1_000_000].encode()])[0]
    assert alone == pytest.approx(before + after - seam, rel=1e-9)
    assert langid.classify(model, [text, text + "б"])[0] == ["xx", "xx"]


def test_equal_code_lengths_take_the_first_name(make_docs):
    docs = make_docs(["abc"] * 4, lang=["m", "k", "k", "m"])
    model = langid.train(docs, "text", "lang")
    assert langid.classify(model, ["abc", "cab"]) == (["k", "k"], [pytest.approx(0.5), pytest.approx(0.5, abs=0.5)])


def test_a_language_of_long_texts_is_learned(spark, make_docs, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_BYTES", 100)
    rng = random.Random(6)
    texts = [language(rng, "aeiou", 80) for _ in range(6)] + [language(rng, "xyzvw", 8) for _ in range(6)]
    docs = make_docs(texts, lang=["long"] * 6 + ["short"] * 6)
    model = langid.train(docs, "text", "lang")
    assert model.languages == ["long", "short"]
    assert langid.classify(model, [texts[0], texts[-1]])[0] == ["long", "short"]
    monkeypatch.setattr(langid, "SAMPLE_TOTAL", 150)
    kept = langid.sample_per_language(docs.select("text", "lang"))
    sizes = {r["lang"]: r["n"] for r in kept.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert sizes["long"] == 1 and 1 < sizes["short"] <= 6


# SimHash


def slow_print(text, shingle):
    words = (text or "").encode().lower().split()
    n = max(1, len(words) - shingle + 1) if words else 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(n)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, radius):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [find(i) for i in range(len(prints))]


def test_near_duplicates(make_docs, held, odd_texts):
    rng = random.Random(5)
    base = [sentence(rng, 150) for _ in range(20)]
    texts = [*odd_texts]
    for text in base:
        for _ in range(rng.randrange(1, 8)):
            words = text.split()
            words[rng.randrange(len(words))] = "other"
            texts.append(" ".join(words))
    docs = make_docs(texts).withColumn("print", F.lit("clash")).withColumn("key", F.lit(0))
    rows = {r["key"]: r for r in simhash.near_duplicates(docs, held).collect()}
    prints = [slow_print(t, 3) for t in texts]
    assert [rows[i]["print"] % (1 << 64) for i in range(len(texts))] == prints
    assert [rows[i]["component"] for i in range(len(texts))] == slow_components(prints, 3)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_all_links_within_the_radius(spark, held, radius):
    rng = random.Random(radius)
    prints = []
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(12):
            flips = rng.sample(range(64), rng.randrange(0, 4))
            prints.append(centre ^ sum(1 << b for b in flips))
    prints = sorted({*prints})
    table = spark.createDataFrame([(simhash.signed(p),) for p in prints], "print bigint")
    links = simhash.near_links(table, radius)
    for row in links.collect():
        assert ((row["a"] ^ row["b"]) % (1 << 64)).bit_count() <= radius
    roots = {r["node"]: r["root"] for r in components(links, held).collect()}
    mine = [roots.get(simhash.signed(p), simhash.signed(p)) for p in prints]
    want = slow_components(prints, radius)
    assert len({*zip(mine, want, strict=True)}) == len({*mine}) == len({*want})


def test_components_of_a_path_and_a_star(spark, held):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    table = spark.createDataFrame(links + links, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components(table, held).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_simhash_of_an_empty_table_and_null_keys(make_docs, held):
    assert simhash.near_duplicates(make_docs([]), held).count() == 0
    docs = make_docs(["same text", "same text"], doc_id=[None, None])
    assert [r["component"] for r in simhash.near_duplicates(docs, held).collect()] == [None, None]


# repeated strings


def slow_spans(texts, span):
    times = defaultdict(int)
    raw = [(t or "").encode() for t in texts]
    for text in raw:
        for i in range(len(text) - span + 1):
            times[text[i : i + span]] += 1
    found = []
    for text in raw:
        mask = [False] * len(text)
        for i in range(len(text) - span + 1):
            if times[text[i : i + span]] > 1:
                mask[i : i + span] = [True] * span
        kept = bytes(b for b, m in zip(text, mask, strict=True) if not m)
        runs = sum(m and not (i and mask[i - 1]) for i, m in enumerate(mask))
        found.append((len(text), sum(mask), runs, kept))
    return found


@pytest.mark.parametrize("span", [5, 12, 40, 200])
def test_repeated_strings(make_docs, held, odd_texts, span):
    rng = random.Random(span)
    passage = [sentence(rng, 60), sentence(rng, 9), "ab" * 150]
    texts = [t if t is None else t[:3000] for t in odd_texts]
    for _ in range(40):
        parts = [sentence(rng, rng.randrange(30)), rng.choice(passage), sentence(rng, 8)]
        texts.append("".join(parts[: rng.randrange(1, 4)]))
    texts += [passage[0], passage[0], texts[-1]]
    docs = make_docs(texts).withColumn("kept", F.lit("clash")).withColumn("rows", F.lit(2))
    rows = {r["row"]["doc_id"]: r for r in suffixes.remove_repeats(docs, held, span).collect()}
    want = slow_spans(texts, span)
    for i, expected in enumerate(want):
        row = rows[i]
        assert (row["n_bytes"], row["n_removed"], len(row["spans"]), bytes(row["kept"])) == expected


def test_names_that_share_one_half_are_apart():
    names = np.array([5, 5, 7], np.uint64)
    more = np.array([1, 2, 1], np.uint64)
    targets = np.zeros(3, np.int64)
    held = suffixes.Names(names, targets, more)
    other = suffixes.Names(names[1:2] * 0 + 7, targets[:1], more[1:2])
    blocks = pa.Table.from_batches([held.blocks(0, False, 4), other.blocks(1, False, 4)])
    found = {r["shard"]: r for r in suffixes.recurring(blocks).to_pylist()}
    sizes = {0: len(held.names), 1: 1}
    bits = {
        i: np.unpackbits(np.frombuffer(found[i]["repeated"], np.uint8), count=n).astype(bool)
        for i, n in sizes.items()
    }
    assert bits[0][held.row].tolist() == [False, False, False] and bits[1].tolist() == [False]


def test_both_hashes_tell_strings_apart():
    rng = random.Random(8)
    raw = bytes(rng.choice(b"ab") for _ in range(4000))
    shard = suffixes.Shard([len(raw)], zstandard.compress(raw), 200)
    places = np.arange(len(raw) - 40)
    distinct = {raw[p : p + 40] for p in places.tolist()}
    for half in shard.strong_names(places, 40):
        assert len(np.unique(half)) == len(distinct)


def test_names_parted_by_one_of_the_same_first_bits():
    names = np.array([8, 9, 8, 9, 8, 1 << 40], np.uint64)
    more, targets = np.zeros(6, np.uint64), np.array([1, 1, 1, 0, 1, 1])
    held = suffixes.Names(names, targets, more)
    assert (held.names[held.row] == names).all() and (held.targets[held.row] == targets).all()
    assert held.targets.tolist() == sorted(held.targets.tolist())
    blocks = pa.Table.from_batches([held.blocks(0, False, 1)])
    repeated = []
    for target in (0, 1):
        for r in suffixes.recurring(blocks.filter(pc.equal(blocks["target"], target))).to_pylist():
            repeated += np.unpackbits(np.frombuffer(r["repeated"], np.uint8), count=r["n"]).tolist()
    assert np.array(repeated)[held.row].tolist() == [1, 0, 1, 0, 1, 0]


@pytest.mark.parametrize("size", [5, 8, 15, 16, 17, 40, 200])
def test_near_names_are_equal_where_strings_are(size):
    rng = random.Random(size)
    part = bytes(rng.choice(b"ab") for _ in range(700))
    raw = part + b"\0" * 300 + bytes(rng.choice(b"abc") for _ in range(40_000)) + part + b"ab" * 200
    shard = suffixes.Shard([len(raw)], zstandard.compress(raw), 200)
    places = np.arange(len(raw) - size + 1)
    places = places[(places < 1500) | (places % 7 == 0) & (places < 9000) | (places > 20_000)]
    strings = {raw[p : p + size]: i for i, p in enumerate(places.tolist())}
    want = [strings[raw[p : p + size]] for p in places.tolist()]
    for half in shard.near_names(places, size):
        assert len(np.unique(half)) == len(strings)
        assert (half == half[want]).all()


def test_strings_that_overlap_share_their_hashes(monkeypatch):
    """27 mixes for each half of a name of 200 bytes when each starts from its first."""
    rng = random.Random(5)
    part, other = rng.randbytes(5000), rng.randbytes(5000)
    raw = part + other + part
    mixes = [0]

    def counted(mix):
        def run(value, factor):
            mixes[0] += len(value)
            return mix(value, factor)

        return run

    for name in ("_mix", "_turn"):
        monkeypatch.setattr(suffixes, name, counted(getattr(suffixes, name)))

    def step(names_of, short):
        steps = suffixes.Steps(suffixes.Shard([len(raw)], zstandard.compress(raw), 200), 0)
        before = mixes[0]
        names = names_of(steps)
        blocks = pa.Table.from_batches([names.blocks(0, short, 0)])
        return steps, suffixes.recurring(blocks).to_pylist(), mixes[0] - before

    _, one, _ = step(lambda s: s.sampled(), True)
    _, two, first_steps = step(lambda s: s.longer(one), False)
    steps, three, all_steps = step(lambda s: s.rest(one, two), False)
    assert len(steps.open) > 4000
    assert all_steps - first_steps < 2 * 16 * len(steps.open)
    covered = steps.covered(one, two, three)
    assert covered[:5000].all() and covered[10_000:].all() and not covered[5010:9990].any()


def test_every_shift_meets_the_cover():
    for v, cover in suffixes.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == {*range(v)}


def test_repeats_in_an_empty_table(make_docs, held):
    assert suffixes.remove_repeats(make_docs([]), held).count() == 0
