"""Language identification, language model and toxicity on texts made for the purpose."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardwatch.llm import common, language_model, languages, substring_dedup, toxicity

PARTS = {"en": ["the", "ing", "tion", "wh", "and", "sh"], "de": ["sch", "ung", "keit", "der", "ich", "ß"], "el": ["και", "του", "μου", "ση", "λο", "θα"]}


def words(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, lang, rng.randint(3, 80)), lang, "s", 0) for i, lang in enumerate(itertools.islice(itertools.cycle(PARTS), 240))]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_languages(spoken):
    got = languages.identify(spoken, languages.remainder("doc_id", 5) != 0, ("doc_id", "lang")).collect()
    assert len(got) == 240
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_spans_of_mixed_text(spark, spoken):
    rng = random.Random(4)
    text = " ".join([words(rng, "en", 30), words(rng, "de", 25), words(rng, "el", 20)])
    docs = spoken.unionByName(spark.createDataFrame([(1_000, text, None, "s", 0)], spoken.schema))
    row = languages.identify(docs, F.lit(True)).where("doc_id = 1000").first()
    assert [s.lang for s in row.spans] == ["en", "de", "el"]
    assert [s.stop for s in row.spans] == [pytest.approx(30, abs=2), pytest.approx(55, abs=2), 75]


def test_texts_without_language(crowded, no_docs):
    got = {r.doc_id: r for r in languages.identify(crowded, F.lit(True)).collect()}
    assert {got[i].lang_pred for i in (1, 2, 3, 13)} == {"und"} and {got[i].score for i in (1, 2, 3, 13)} == {0.0}
    assert got[4].lang_pred != "und" and got[12].lang_pred != "und"
    assert {r.lang_pred for r in languages.identify(crowded, F.lit(False)).collect()} == {"und"}
    assert languages.identify(no_docs, F.lit(True)).collect() == []


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    counts = np.array([0, 5, 1, 4])
    emission = rng.normal(0, 3, (counts.sum(), 3))
    got = languages.viterbi(emission, counts, penalty=2.0)
    at = 0
    for n in counts:
        own = emission[at : at + n]
        worth = lambda path: sum(own[i, k] for i, k in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))  # noqa: E731, B023
        best = max(itertools.product(range(3), repeat=int(n)), key=worth)
        assert tuple(got[at : at + n]) == best
        at += n


def katz(rows, trained):
    """Straight from the definition."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts = [(d, [w.decode() for w in (t or "").translate(lower).encode().split()] + ["</s>"]) for d, t, *_ in rows]
    one, two, n = collections.Counter(), collections.defaultdict(collections.Counter), 0
    for d, w in texts:
        if trained(d):
            n += 1
            one.update(w)
            for a, b in zip(["<s>", *w], w):
                two[a][b] += 1
    total, distinct, k = sum(one.values()), len(one), language_model.K

    def kept(counts):
        """Good and Turing's rule with smoothed numbers, written out."""
        of = collections.Counter(counts)
        points = [r for r in range(1, k + 2) if of[r]]
        logs = []
        for i, r in enumerate(points):
            low = points[i - 1] if i else 0
            high = points[i + 1] if i + 1 < len(points) else 2 * r - low
            logs.append((math.log(r), math.log(2 * of[r] / (high - low))))
        slope, start = -1.1, 0.0
        if len(logs) > 1:
            mx, my = (sum(c) / len(logs) for c in zip(*logs))
            slope = sum((x - mx) * (y - my) for x, y in logs) / sum((x - mx) ** 2 for x, _ in logs)
            start = my - slope * mx
        z = lambda r: math.exp(start + min(slope, -1.1) * math.log(r))
        most, turing, factor = (k + 1) * z(k + 1) / z(1), True, {}
        for r in range(1, k + 1):
            star = (r + 1) * z(r + 1) / z(r)
            if turing and of[r] and of[r + 1]:
                raw = (r + 1) * of[r + 1] / of[r]
                turing = abs(raw - star) > 1.65 * math.sqrt((r + 1) ** 2 * of[r + 1] / of[r] ** 2 * (1 + of[r + 1] / of[r]))
                star = raw if turing and 0 < raw < r else star
            d = (star / r - most) / (1 - most)
            factor[r] = d if 0 < d < 1 else star / r
        return lambda c: c * (factor[c] if c <= k else 1)

    single = kept(one.values())
    p = {w: single(c) / total for w, c in one.items()}
    unknown = 1 - sum(p.values())
    pair = kept(c for v in two.values() for c in v.values())

    def log_p(h, w):
        if h not in two:
            return math.log10(p.get(w, unknown))
        of_h = n if h == "<s>" else one[h]
        used = sum(pair(c) for c in two[h].values())
        scale = 1 - 0.5 / of_h if used >= of_h - 1e-9 else 1.0
        if w in two[h]:
            return math.log10(pair(two[h][w]) * scale / of_h)
        return math.log10((1 - used * scale / of_h) / (1 - sum(p[x] for x in two[h])) * p.get(w, unknown))

    out = []
    for d, w in texts:
        base = sum(math.log10((one[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        out.append((d, len(w), sum(x in one for x in w), total, base, sum(log_p(h, x) for h, x in zip(["<s>", *w], w))))
    vocabulary = [*one, "<new>"]
    for h in [*list(two)[:5], "<s>", "nowhere"]:
        assert sum(10 ** log_p(h, w) for w in vocabulary) == pytest.approx(1, abs=1e-9)
    return out


def test_discounts_of_given_tables_follow_the_rule(sf_dir):
    """On the words and pairs of the given documents no factor is the half count that once stood in for all."""
    docs = pd.read_parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet").text.dropna()
    one, two = collections.Counter(), collections.Counter()
    for text in docs:
        words = text.encode().lower().split()
        one.update(words)
        two.update(zip(words, words[1:]))
    for counts in (one, two):
        of = np.bincount(np.minimum(list(counts.values()), language_model.K + 2), minlength=language_model.K + 3)[: language_model.K + 2]
        factor = language_model.discounts(of.astype(float))
        assert all(0 < f < 1 for f in factor[1:]) and not any(f == 1 - 0.5 / r for r, f in enumerate(factor) if r)
    # One odd number changes its neighbours' factors most, and leaves all between 0 and 1.
    for odd in (0, 5, 10**6):
        factor = language_model.discounts(np.array([0, 1000, 400, 200, odd, 80, 60.0]))
        assert ((factor[1:] > 0) & (factor[1:] < 1)).all()


def test_long_words_with_equal_powers_are_told_apart(spark):
    """Two words of 1,024 letters in Thue and Morse's order, which powers modulo 2**64 confuse."""
    order = [bin(i).count("1") % 2 for i in range(1_024)]
    a, b = ("".join("ab"[x ^ flip] for x in order) for flip in (0, 1))
    blob = np.frombuffer(f"{a} {b} ".encode(), np.uint8)
    (hashes,) = common.word_hashes(blob, np.array([0, 1_025]), np.array([1_024, 2_049]))
    assert hashes[0] != hashes[1]


def test_ill_formed_texts_end_no_job(spark, spoken):
    rows = spark.sql("select 1L doc_id, cast(concat(x'ff', cast(' der Hund und die Katze' as binary)) as string) text, 'de' lang, 'a' source")
    docs = spoken.select("doc_id", "text", "lang", "source").unionByName(rows)
    assert languages.identify(docs, F.lit(True), ("doc_id",)).where("doc_id = 1").count() >= 1
    labels = docs.select("doc_id", F.lit(0).alias("toxic"))
    assert toxicity.toxicity(docs, labels, F.lit(True)).where("doc_id = 1").count() >= 1
    (row,) = substring_dedup.cut_words(rows).collect()
    assert row.n_words == 6 and row.n_removed == 0


@pytest.mark.parametrize("chunk", [language_model.CHUNK_BYTES, 1_000])
def test_language_model(crowded, edge_rows, monkeypatch, chunk):
    monkeypatch.setattr(language_model, "CHUNK_BYTES", chunk)
    if chunk == 1_000:
        monkeypatch.setattr(language_model, "HOT_SHARE", 1e-3)
    crc = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 != 0
    got = language_model.score_documents(crowded, languages.remainder("doc_id", 10) != 0).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[5], 6))
    for a, b in zip(sorted(got, key=order), sorted(katz(edge_rows, crc), key=order), strict=True):
        assert tuple(a)[:4] == b[:4]
        assert tuple(a)[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("share", [3e-3, 0.05, 1.0])
def test_language_model_keeps_pairs_of_rare_words(crowded, edge_rows, monkeypatch, share):
    """Scores are those of the definition, however few words are frequent enough for every task to know."""
    monkeypatch.setattr(language_model, "SHARE", share)
    monkeypatch.setattr(language_model, "HOT_SHARE", 10 * share)
    crc = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 != 0
    got = language_model.score_documents(crowded, languages.remainder("doc_id", 10) != 0).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[5], 6))
    for a, b in zip(sorted(got, key=order), sorted(katz(edge_rows, crc), key=order), strict=True):
        assert tuple(a)[:4] == b[:4]
        assert tuple(a)[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


def test_language_model_without_rows(edge_docs, no_docs):
    assert language_model.score_documents(no_docs, F.lit(True)).collect() == []
    got = language_model.score_documents(edge_docs, F.lit(False)).collect()
    assert len(got) == edge_docs.count() and {r.score for r in got} == {0.0}


@pytest.fixture(scope="module")
def marked(spark):
    """Toxic words in a quarter of the texts; one clean text has many copies with a word of its own."""
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        text, toxic = words(rng, "en", rng.randint(20, 120)).split(), int(i % 4 == 0)
        if toxic:
            for _ in range(rng.randint(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["Vile", "rotten", "scumlike" + rng.choice("abc")]))
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    copied = words(rng, "en", 60) + " vile onlyhere thisone"
    rows += [(i, copied + f" {i}") for i in range(400, 450)]
    labels += [(i, 1) for i in range(400, 450)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity(marked):
    docs, labels = marked
    trained = languages.remainder("doc_id", 5) != 0
    got = toxicity.toxicity(docs, labels, trained).join(labels, "doc_id").where("doc_id < 400").where(languages.remainder("doc_id", 5) == 0).collect()
    assert len(got) > 60
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.95
    texts = dict(docs.collect())
    for r in got:
        assert r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1
        for s in r.spans:
            assert texts[r.doc_id].lower().encode()[s.start : s.stop].decode().startswith(("vile", "rotten", "scumlike"))


def test_toxicity_in_long_documents(spark):
    """Where every toxic document is long, its toxic words are still learned and found."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(600):
        text, toxic = words(rng, "en", rng.choice([500, 900])).split(), int(i % 3 == 0)
        if toxic:
            for _ in range(rng.randint(1, 6)):
                text[rng.randrange(len(text))] = rng.choice(["vilsnort", "grubfang", "muckwretch"])
        elif rng.random() < 0.5:
            text = text[: rng.randint(20, 400)]
        rows.append((i, " ".join(text)))
        labels.append((i, toxic))
    docs, labels = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    trained = languages.remainder("doc_id", 5) != 0
    got = toxicity.toxicity(docs, labels, trained).join(labels, "doc_id").where(~trained).collect()
    assert np.mean([r.predicted for r in got if r.toxic]) >= 0.9
    assert np.mean([r.predicted for r in got if not r.toxic]) <= 0.05
    text = dict(rows)
    marked = [text[r.doc_id][s.start : s.stop] for r in got if r.toxic for s in r.spans]
    assert len(marked) >= sum(r.toxic for r in got) and set(marked) <= {"vilsnort", "grubfang", "muckwretch"}


def test_field_runs():
    rng = np.random.default_rng(1)
    for n, places in ((0, []), (400, [3]), (401, []), (5_000, [0, 2_499, 4_999]), (100_003, range(0, 100_003, 7))):
        held = np.zeros(n, bool)
        held[list(places)] = True
        runs = toxicity.field_runs(held, rng)
        assert all(a < b for a, b in runs if n) and all(r[1] <= s[0] for r, s in zip(runs, runs[1:]))
        assert sum(b - a for a, b in runs) <= max(toxicity.FIELD_WORDS, 0) or n <= toxicity.FIELD_WORDS
        if len(places) <= 3:  # few enough that each is read
            assert all(any(a <= p < b for a, b in runs) for p in places)


def test_toxicity_on_odd_rows(crowded, no_docs, marked, spark):
    docs, labels = marked
    model = toxicity.fit(docs, labels.select("doc_id", (F.col("toxic") > 0).alias("toxic")))
    got = toxicity.score_documents(crowded, model).collect()
    assert len(got) == crowded.count() and all(r.predicted == 0 for r in got if r.doc_id in (1, 2, 3))
    none = spark.createDataFrame([], labels.schema)
    assert {r.predicted for r in toxicity.toxicity(crowded, none, F.lit(True)).collect()} == {0}
    assert toxicity.toxicity(no_docs, labels, F.lit(True)).collect() == []


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(2)
    weights, moves = rng.normal(0, 1, (4, 2)), rng.normal(0, 1, (2, 2))
    counts = np.array([3, 0, 5])
    kinds = rng.integers(0, 4, 8)
    got, pairs, log_z = toxicity.marginals(weights, moves, kinds, counts)
    wanted, wanted_pairs, total, at = np.zeros((8, 2)), np.zeros((2, 2)), 0.0, 0
    for n in (3, 5):
        own, z, sums = kinds[at : at + n], 0.0, np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=n):
            worth = math.exp(sum(weights[o, y] for o, y in zip(own, path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            z += worth
            for i, y in enumerate(path):
                wanted[at + i, y] += worth
            for a, b in zip(path, path[1:]):
                sums[a, b] += worth
        wanted[at : at + n] /= z
        wanted_pairs += sums / z
        total += math.log(z / 2)  # either label may begin, each with one half
        at += n
    assert np.allclose(got, wanted) and np.allclose(pairs, wanted_pairs) and log_z == pytest.approx(total)
