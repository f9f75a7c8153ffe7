"""SimHash groups, decontamination, licences, mixing and neighbours on odd rows and against brute force."""

import hashlib
import itertools
import random
import re
import textwrap

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wardwatch.llm import decontamination, licenses, mixing, neighbors, simhash


def components(fps, budget=2):
    """Smallest id of each fingerprint's component, and fingerprints by row."""
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= budget:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return [find(f) for f in fps]


def simhash_of(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("hot", [simhash.HOT_BLOCK, 0, 2])
def test_simhash(crowded, edge_rows, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_BLOCK", hot)
    fps = [simhash_of(t) for _, t, *_ in edge_rows]
    groups = components(fps)
    least = {}
    for (d, *_), g in zip(edge_rows, groups):
        least[g] = min(x for x in (least.get(g), d) if x is not None) if d is not None or least.get(g) is not None else None
    wanted = [(d, f"{f:016x}", least[g]) for (d, *_), f, g in zip(edge_rows, fps, groups)]
    got = [tuple(r) for r in simhash.simhash_groups(crowded).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


def test_one_of_each_group_stays(crowded, edge_rows, no_docs):
    last = 1 << 63
    groups = components([simhash_of(t) for _, t, *_ in edge_rows])
    ids = [last if r[0] is None else r[0] for r in edge_rows]
    kept = simhash.keep_one(crowded)
    assert kept.dtypes == crowded.dtypes
    wanted = sorted(min(d for d, h in zip(ids, groups) if h == g) for g in set(groups))
    assert sorted(last if r.doc_id is None else r.doc_id for r in kept.collect()) == wanted
    assert simhash.keep_one(no_docs).collect() == [] and simhash.simhash_groups(no_docs).collect() == []


@pytest.mark.parametrize("shared", [0, 21])
def test_trie_pairs(shared):
    rng = np.random.default_rng(shared)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [b ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for b in base for i, j in rng.integers(0, 64 - shared, (6, 2))]
    keys = np.unique(np.r_[base, np.array(flips, np.uint64)])
    left, right = simhash.trie_pairs(keys, shared, 2)
    got = {(min(a, b), max(a, b)) for a, b in zip(keys[left].tolist(), keys[right].tolist())}
    same_block = lambda a, b: not shared or a >> (64 - shared) == b >> (64 - shared)
    wanted = {(a, b) for a, b in itertools.combinations(keys.tolist(), 2) if (a ^ b).bit_count() <= 2 and same_block(a, b)}
    assert got == wanted and len(left) == len(wanted)


@pytest.mark.parametrize("hot", [simhash.HOT_BLOCK, 5])
def test_long_chain_is_one_component(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_BLOCK", hot)
    chain = [0]
    for i in range(60):
        chain.append(chain[-1] ^ (1 << i))
    fps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, 100 - i) for i, f in enumerate(chain)], "fp bigint, least bigint")
    got = simhash.components(simhash.trie_links(fps), fps).collect()
    assert {r.component_id for r in got} == {40} and len(got) == 61


def words13(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))


def judge(docs, items, size=13):
    windows = {(str(i) if i is not None else "", tuple(w[p : p + size])) for i, t in items for w in [words13(t)] if w for p in range(max(1, len(w) - size + 1))}
    out = []
    for d, t, *_ in docs:
        w = words13(t)
        hit, found = set(), set()
        for item, win in windows:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p : p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("short", [False, True])
@pytest.mark.parametrize("block_words", [decontamination.BLOCK_WORDS, 100])
def test_contamination(spark, crowded, edge_rows, monkeypatch, short, block_words):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", block_words)
    text = dict((r[0], r[1]) for r in edge_rows)
    items = [(1, text[6][:300]), (10, text[45]), (2, None), (3, ""), (None, text[12][:40]), (1, "more of one id " * 4), (5, text[20].title())]
    if short:
        items += [(7, "Word"), (8, "É è"), (9, "tick, TOCK tick")]
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("words", F.lit("x"))
    got = [tuple(r) for r in decontamination.contamination(crowded, bench).drop("text_hash").collect()]
    wanted = judge(edge_rows, items)
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))
    clean = decontamination.clean_documents(crowded, bench)
    assert clean.dtypes == crowded.dtypes
    assert sorted(map(repr, (r.doc_id for r in clean.collect()))) == sorted(repr(w[0]) for w in wanted if not w[-1])


def test_empty_benchmark_and_documents(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.contamination(edge_docs, none).where("contaminated OR n_hit > 0").count() == 0
    assert decontamination.contamination(no_docs, spark.createDataFrame([(1, "a b c")], none.schema)).collect() == []


def test_mixing_odd_rows_against_sql(spark, crowded, edge_rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", edge_rows)
    wanted = con.execute(mixing.SQL).fetchall()
    got = mixing.mix_sources(crowded).drop("source").collect()
    form = lambda rows: sorted((repr(r[0]), r[1], r[2], round(r[3], 6), r[4]) for r in rows)
    assert form(got) == form(wanted)
    taken = mixing.mixed_documents(crowded)
    rows = taken.collect()
    assert {"size", "source_size", "target", "taken", "score"} <= set(taken.columns)
    assert sum(r.taken for r in rows) == sum(r[4] for r in wanted)
    assert all(0 < r.taken <= 2 * r.size for r in rows if r.size)


@pytest.mark.parametrize("same_text", [False, True])
def test_mixing_rows_that_share_an_id(spark, same_text):
    """A source without ids, of different rows or of copies of one, comes as near its target as others."""
    text = F.lit("one two three four five six seven eight nine ten") if same_text else F.concat(F.lit("w "), F.col("id").cast("string"))
    rows = spark.range(1_000).select(F.lit(None).cast("bigint").alias("doc_id"), text.alias("text"), F.lit("a").alias("source"))
    other = spark.range(9_000).select(F.col("id").alias("doc_id"), F.lit("x y").alias("text"), F.lit("b").alias("source"))
    docs = rows.unionByName(other).withColumns({"lang": F.lit("en"), "h": F.lit(1), "_size": F.lit(2)}).repartition(7)
    for out in (mixing.mix_sources(docs), mixing.mixed_documents(docs)):
        got = {r.source: r for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
        for r in got.values():
            assert abs(r.taken - r.target) <= 0.01 * r.target
    assert mixing.mixed_documents(docs).where("taken > 2 * size").count() == 0


def test_mixing_nothing(no_docs, edge_docs):
    assert mixing.mix_sources(no_docs).collect() == []
    wordless = edge_docs.where("doc_id < 4")
    assert {r.taken for r in mixing.mix_sources(wordless).collect()} == {0}


def test_budgets_are_nested(edge_docs):
    sized = edge_docs.select("source", mixing.n_words("text").alias("size"), mixing.row_hash(mixing.row_digest()).alias("h"))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cuts = []
    for share in (0.1, 0.3, 0.7):
        targets = totals.withColumn("target", F.col("source_size") * share)
        plan = {r.source: r for r in mixing.thresholds(sized, targets).collect()}
        cuts.append({s: p.cut for s, p in plan.items()})
        for s, p in plan.items():
            own = [r for r in sized.where(F.col("source").eqNullSafe(F.lit(s))).collect()]
            near = sum(r.size for r in own if r.h < p.cut)
            together = {h: sum(r.size for r in own if r.h == h) for h in {r.h for r in own}}
            assert abs(near - p.target) <= max(together.values())
    assert all(a[s] <= b[s] for a, b in zip(cuts, cuts[1:]) for s in a)


def test_licences(spark, crowded, no_docs):
    notice = licenses.TEMPLATES["MIT notice"]
    rows = [
        (1, "Prose before.\nReleased under the MIT License.\nProse after."),
        (2, notice.replace("including without limitation", "including but not limited to")),
        (3, "licensed UNDER the apache license version 2 0"),
        (4, "The MIT licence was released under the sea."),
        (5, notice + "\n" + "other words " * 400),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.part): (r.license, round(r.dice, 3)) for r in licenses.license_matches(docs).collect()}
    assert got[1, 2] == ("MIT line", 1.0) and got[3, 0] == ("Apache-2.0 line", 1.0)
    assert got[2, 0][0] == "MIT notice" and 0.9 < got[2, 0][1] < 1 and got[5, 1] == ("MIT notice", 1.0)
    assert not any(d == 4 for d, _ in got) and (5, 0) not in {k for k in got if got[k][0] != "MIT notice"}
    assert licenses.license_matches(crowded).collect() == [] == licenses.license_matches(no_docs).collect()


def test_whole_licence_texts(spark):
    """Genuine texts with title and copyright line are found, in one line and wrapped."""
    titles = {"MIT text": "MIT License", "ISC text": "ISC License", "BSD-2-Clause text": "BSD 2-Clause License", "BSD-3-Clause text": "BSD 3-Clause License"}
    whole = [f"{titles.get(name, '')}\n\nCopyright (c) 2019, Jane Q. Doe. All rights reserved.\n\n{text}" for name, text in licenses.FULL_TEXTS.items()]
    rows = list(enumerate([*whole, *("\n".join(textwrap.fill(p, 70) for p in t.split("\n")) for t in whole)]))
    got = {r.doc_id: r.license for r in licenses.license_matches(spark.createDataFrame(rows, "doc_id bigint, text string")).where("part = 0").collect()}
    assert [got.get(i) for i, _ in rows] == [*licenses.FULL_TEXTS] * 2


def _licence_documents(seed: int = 5) -> list[tuple[int, str | None]]:
    """Whole, wrapped, commented and embedded texts, some with words changed, among prose."""
    rng = random.Random(seed)
    prose = lambda n: " ".join(rng.choice(["water", "under", "general", "software", "license", "stone", "by", "the"]) for _ in range(n))
    texts: list[str | None] = [None, "", "license", prose(2_000), "the mit license " * 50]
    for text in licenses.KNOWN.values():
        wrapped = textwrap.fill(text, 60)
        words = text.split()
        for i in rng.sample(range(len(words)), len(words) // 20):
            words[i] = "zebra"
        texts += [text, wrapped, "\n".join("# " + line for line in wrapped.split("\n"))]
        texts += [prose(rng.randint(0, 300)) + "\n" + wrapped + "\n" + prose(rng.randint(1, 400)), prose(90) + " " + " ".join(words) + " " + prose(70)]
    return [*enumerate(texts), (3, "Released under the MIT License."), (0, None)]


def test_licences_wrapped_and_embedded(spark):
    """The query equals its SQL, and finds long notices inside longer texts, wrapped or behind comment marks."""
    rows = _licence_documents()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.part, r.license, round(r.dice, 9), r.first_word) for r in licenses.license_matches(docs).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id bigint, text varchar)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    # One id holds two texts, which the query tells apart and the SQL does not.
    want = {(a, b, c, round(d, 9), e) for a, b, c, d, e in con.execute(licenses.sql()).fetchall()}
    assert got == want
    names = [*licenses.KNOWN]
    found = {(d, name) for d, part, name, *_ in got}
    for k, (name, text) in enumerate(licenses.KNOWN.items()):
        if len(text.split()) >= 30:
            assert {i for i in range(5 + 5 * k, 10 + 5 * k) if (i, name) in found} == set(range(5 + 5 * k, 10 + 5 * k)), name
    assert len(names) == len(licenses.TEMPLATES) + len(licenses.FULL_TEXTS)


def test_needed_words():
    """What holds none of the needed words of a template shares too little of it, for any template and threshold."""
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice("aa bb cc dd license ee software ff of gg".split()) for _ in range(rng.randint(2, 40))]
        bigrams = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        for least in (0.3, 0.5, 0.8, 1.0):
            needed = set(licenses.needed_words(bigrams, least))
            rest = sum(not needed & set(pair.split()) for pair in bigrams)
            assert 2 * rest / (rest + len(bigrams)) < least  # the best part without them is what is left


VECTORS = "vec_id bigint, embedding array<float>, label int"


def test_neighbours_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 0.0], 0), (3, None, 0), (4, [nan, 1.0], 0), (5, [inf, 0.0], 0), (6, [None, 1.0], 0), (7, [], 0)]
    rows += [(8, [1.0, 2.0, 3.0], 0), (20, [-1.0, 0.5], 0), (40, [0.0, 0.0], 0), (None, [1.0, 1.0], 0), (1, [1.0, 0.0], 0), (9, [2.0, 0.0], 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("list", F.lit(1)).withColumn("v", F.lit(2))
    got = [tuple(r) for r in neighbors.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 9, 2.0), (0, 2, 1, 1.0), (0, 3, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -1.0), (20, 3, 9, -2.0)]
    assert neighbors.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_neighbours_recall_with_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "CHUNK", 300)
    rng = np.random.default_rng(4)
    centers = rng.normal(0, 1, (30, 16))
    x = (centers[rng.integers(0, 30, 6_000)] + rng.normal(0, 0.4, (6_000, 16))).astype(np.float32) * rng.uniform(0.5, 2, (6_000, 1)).astype(np.float32)
    x[rng.permutation(6_000)[:2_000]] = x[0]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS).repartition(4)
    got = neighbors.nearest(df, F.col("vec_id") % 20 == 0).toPandas()
    hits = 0
    wide = x.astype(float)
    for q, own in got.groupby("query_id"):
        assert own.sort_values("rank")["rank"].tolist() == list(range(1, 21))
        score = np.zeros(len(x))
        for d in range(16):
            score += wide[q, d] * wide[:, d]
        assert np.array_equal(score[own.vec_id], own.score)
        score[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(len(x)), -score))[:20]) & set(own.vec_id))
    assert got.query_id.nunique() == 300 and hits / 6_000 >= 0.9


def test_neighbours_recall_does_not_hang_on_the_first_probes(spark, monkeypatch):
    """From two lists of thirty, calibration goes on until the sampled queries find their neighbours."""
    monkeypatch.setattr(neighbors, "PROBES", 2)
    monkeypatch.setattr(neighbors, "LEAST_ROWS", 1)
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (6_000, 24)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS).repartition(4)
    got = neighbors.nearest(df, F.col("vec_id") % 20 == 0).toPandas()
    hits = 0
    for q, own in got.groupby("query_id"):
        score = x.astype(float) @ x[q].astype(float)
        score[q] = -np.inf
        hits += len(set(np.argsort(-score)[:20]) & set(own.vec_id))
    assert got.query_id.nunique() == 300 and hits / 6_000 >= 0.9
