"""The corpus operators against plain Python, on small tables with awkward rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airgrid.llm import (
    arrays,
    components,
    decontaminate,
    jaccard_join,
    mixing,
    quality_classifier,
    quality_rules,
    secrets,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filters,
)

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int, start int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(spark, texts, sources=None):
    rows = [
        (i, t, "en", sources[i] if sources else "s", len(t) if t is not None else None, 1, None)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocabulary = ["w%d" % i for i in range(60)] + ["Größe", "été", "日本", "𝄞x"]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 90))) for _ in range(25)]
    passage = " ".join(rng.choices(vocabulary, k=55))
    out = [None, "", " \n\t ", "one", "One two", passage, passage, passage.upper()]
    for t in base:
        words = t.split()
        out += [t, t + "\n" + passage, " ".join(words[: len(words) // 2] + ["new"] + words[len(words) // 2 :])]
    out += ["ab " * 60, "x" * 400, "x" * 400 + "y", ("lorem ipsum " * 3000), "a\x0bb\x0cc", t, t]
    return out


def repeated(sequences, length):
    seen, out = set(), []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            key = tuple(s[i : i + length])
            if key in seen:
                gone[i : i + length] = [True] * length
            seen.add(key)
        out.append(gone)
    return out


def test_substring_dedup(spark, texts):
    got = {r.doc_id: r for r in substring_dedup.remove_repeated_words(corpus(spark, texts)).collect()}
    words = [WORD.findall(t or "") for t in texts]
    for i, (w, gone) in enumerate(zip(words, repeated(words, 20), strict=True)):
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[i].n, got[i].n_removed, got[i].kept) == (len(w), sum(gone), kept)


def test_suffix_dedup(spark, texts):
    got = {r.doc_id: r for r in suffix_dedup.remove_repeated_bytes(corpus(spark, texts)).collect()}
    data = [(t or "").encode() for t in texts]
    for i, (d, gone) in enumerate(zip(data, repeated(data, 100), strict=True)):
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        runs = len(re.findall("1+", "".join("01"[g] for g in gone)))
        assert (got[i].n, got[i].n_removed, bytes(got[i].kept), len(got[i].spans)) == (len(d), sum(gone), kept, runs)


def test_dedup_counts_repeated_rows_as_one_document(spark):
    text = " ".join("w%d" % i for i in range(40))
    docs = spark.createDataFrame([(1, text), (1, text), (None, "a b"), (None, None)], "doc_id bigint, text string")
    for out in (substring_dedup.remove_repeated_words(docs), suffix_dedup.remove_repeated_bytes(docs)):
        assert out.count() == 4 and out.where("n_removed > 0").count() == 0


def test_dedup_tells_rows_of_one_id_or_none_apart(spark):
    rng = random.Random(9)
    passage, own, other, last = (" ".join("%s%d" % (c, rng.randrange(10**6)) for _ in range(60)) for c in "abcd")
    nameless = [passage + " " + own, passage + " " + own, other, passage]
    rows = [(None, t) for t in nameless] + [(7, last + " " + other), (7, last), (7, last), (8, own + " x " + last)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    for remove, split, join, length in (
        (substring_dedup.remove_repeated_words, str.split, " ".join, 20),
        (suffix_dedup.remove_repeated_bytes, lambda t: t.encode(), bytes, 100),
    ):
        found = remove(docs).collect()
        kept = sorted(((r.doc_id or 0, bytes(r.kept) if length == 100 else r.kept) for r in found))
        unsigned = spark.sql(f"SELECT xxhash64('{last} {other}') < xxhash64('{last}')").first()[0]
        sevens = [last + " " + other, last] if unsigned else [last, last + " " + other]
        texts = [*nameless, *sevens, own + " x " + last]
        gone = repeated([split(t) for t in texts], length)
        wanted = [
            (i, join([x for x, g in zip(split(t), gone[k], strict=True) if not g]))
            for k, (i, t) in enumerate(zip([0, 0, 0, 0, 7, 7, 8], texts, strict=True))
        ]
        wanted.append(next(w for w, t in zip(wanted, texts, strict=True) if w[0] == 7 and t == last))
        assert kept == sorted(wanted)


def jaccard_components(texts, words, percent):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i : i + words]) for i in range(max(len(w) - words + 1, 1))} if w else set())
    root = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    return sets, root


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (2, 60)])
def test_jaccard_join(spark, texts, words, percent):
    got = {r.doc_id: r for r in jaccard_join.similar_groups(corpus(spark, texts), words, percent).collect()}
    sets, root = jaccard_components(texts, words, percent)
    for i in range(len(texts)):
        assert (got[i].n_shingles, got[i].component_id) == (len(sets[i]), root[i])


def test_jaccard_hot_tokens_and_blocks(spark, monkeypatch):
    rng = random.Random(2)
    common = ["c%d" % i for i in range(40)]
    texts = []
    for _ in range(60):
        words = list(common)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(40)] = "r%d" % rng.randrange(9)
        texts.append(" ".join(words + ["own%d" % rng.randrange(40)] * rng.randint(0, 9)))
    wanted = jaccard_components(texts, 2, 80)[1]
    pairs = jaccard_join.candidates
    monkeypatch.setattr(jaccard_join, "candidates", lambda *a: pairs(*a, hot=1))
    places = jaccard_join.dealt
    monkeypatch.setattr(jaccard_join, "dealt", lambda groups: places(groups, block=3))
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(corpus(spark, texts), 2, 80).collect()}
    assert [got[i] for i in range(len(texts))] == wanted


@pytest.mark.parametrize("hot", [1, 24])
def test_jaccard_of_texts_made_of_common_passages(spark, monkeypatch, hot):
    """Nearly all tokens of a text are hot, and what sets the texts apart is not in their lists."""
    rng = random.Random(9)
    passages = [" ".join(f"p{k}w{i}" for i in range(40)) for k in range(7)]
    texts = []
    for n in range(90):
        parts = [passages[k] for k in sorted(rng.sample(range(7), rng.choice([3, 4, 4])))]
        own = " ".join(f"o{rng.randrange(25)}w{i}" for i in range(rng.choice([0, 3, 12])))
        texts.append(" ".join([*parts, own]) if n % 2 else " ".join([own, *parts]))
    wanted = jaccard_components(texts, 5, 80)[1]
    pairs = jaccard_join.candidates
    monkeypatch.setattr(jaccard_join, "candidates", lambda *a: pairs(*a, hot=hot))
    # Steps before the candidates would join most of these; leave them out.
    monkeypatch.setattr(jaccard_join, "spanning_links", lambda held, percent: [])
    everyone = jaccard_join._pairs

    def not_met_before(left, right, percent, same=False):
        apart = [F.xxhash64("cls", F.lit(k)).alias(f"g{k}") for k in range(3)]
        left, right = (d.select(*[c for c in d.columns if c[0] != "g"], *apart) for d in (left, right))
        return everyone(left, right, percent, same)

    monkeypatch.setattr(jaccard_join, "_pairs", not_met_before)
    got = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(corpus(spark, texts), 5, 80).collect()}
    assert [got[i] for i in range(len(texts))] == wanted
    assert len(set(wanted)) > 20


def test_mix_without_ids(spark):
    """Rows without an id are drawn by their text, so the targets hold for them, too."""
    texts = [f"{'w ' * 9}{i}" for i in range(400)]
    rows = [(None, t, "en", "ab"[i % 4 == 0], 1, 1, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = mixing.mix(docs).groupBy("doc.source").agg(F.sum(F.col("copies") * F.col("size")).alias("n"), F.max("target").alias("t"))
    for r in taken.collect():
        assert abs(r.n - r.t) < 0.15 * r.t


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    rows = components.components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert {r.node: r.root for r in rows} == {i: 1 for i in range(1, 41)} | {100 + i: 100 for i in range(30)}


def test_decontaminate(spark, texts):
    plain = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    items = [(1, texts[5]), (2, "One, TWO"), (3, None), (4, ""), (None, "lorem ipsum " * 6), (5, texts[11]), (5, texts[11])]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, n_words int")
    got = {r.doc_id: r for r in decontaminate.decontaminate(corpus(spark, texts), bench).collect()}
    for i, t in enumerate(texts):
        words, gone, found = plain.findall((t or "").translate(LOW)), set(), set()
        for item, text in items:
            own = plain.findall((text or "").translate(LOW))
            size = min(len(own), 10)
            windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    gone.update(range(k, k + size))
                    if item is not None:
                        found.add(str(item))
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (len(words), len(gone), sorted(found))
    assert decontaminate.drop_contaminated(corpus(spark, texts), bench).count() == sum(not r.n_hit for r in got.values())


def test_quality_rules(spark, texts):
    docs = corpus(spark, texts)
    trusted = spark.createDataFrame([(i,) for i in range(8, 30)], "doc_id bigint")
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs, trusted).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        words = WORD.findall(t)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        counts = Counter(windows)
        inside = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(inside))
        assert (r.n_symbols, r.n_dup_lines) == (sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)))
        assert r.base_failed == (len(words) < 20 or 100 * len(inside) > 30 * len(words))
        assert not (r.kept and r.base_failed)


def test_quality_ratio_against_its_definition(spark):
    import math

    import xxhash

    texts, buckets = ["a b a", "a a", "c d", ""], 64
    docs = corpus(spark, texts)
    trusted = spark.createDataFrame([(0,)], "doc_id bigint")

    def signed(x):
        return x - (1 << 64) if x >= 1 << 63 else x

    def grams(t):
        w = t.split()
        one = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
        two = [xxhash.xxh64_intdigest(b.encode(), xxhash.xxh64_intdigest(a.encode(), 42)) for a, b in zip(w, w[1:])]
        return [signed(x) % buckets for x in one + two]

    raw, good = Counter(g for t in texts for g in grams(t)), Counter(grams(texts[0]))
    ratio = {
        b: round(1000 * (math.log((good[b] + 1) / (sum(good.values()) + buckets)) - math.log((raw[b] + 1) / (sum(raw.values()) + buckets))))
        for b in range(buckets)
    }
    got = {r.doc_id: r.llr for r in quality_rules.quality_rules(docs, trusted, buckets=buckets).collect()}
    for i, t in enumerate(texts):
        assert got[i] == sum(ratio[g] for g in grams(t)) / max(1, 2 * len(t.split()) - 1)


def test_secret_scans(spark):
    token = "qX7vR2mK9pL4wZ8nT1cB6yH3"
    texts = [
        None,
        "",
        "𝄞 Password = 'abc' token: secret=abcdefgh API_key:x.y-z_12 " + "f0" * 13,
        "AKIA" + "Q" * 16 + " AKIA123 secret=token:abcdefg " + "0" * 23,
        "call " + token + " and keitlichenlichkeitbeheitenung ok",
        "password=" + "ab12" * 8 + '" x',
    ] + ["ordinary words stand here and there once more number"] * 3
    docs = corpus(spark, texts)
    got = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    assign = re.compile(secrets.ASSIGN[4:], re.I | re.A)
    for i, t in enumerate(texts):
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m.group(2)) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
        assert [(s.start, s.rank, s.end) for s in got[i].base] == sorted(spans)
        assert set(got[i].base) <= set(got[i].spans)
    assert [(s.start, s.rank, s.end) for s in got[4].spans] == [(5, 3, 5 + len(token))]
    masked = {r.doc_id: r for r in secrets.mask_secrets(docs).collect()}
    assert masked[0].text is None and masked[5].text == '[secret]" x' and masked[5].n_chars == 11
    assert masked[4].text.startswith("call [secret] and") and masked[6].text == texts[6]


def test_models_gather_from_all_documents(spark):
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = ["number " + str(i // 2).translate(letters) * 2 for i in range(5_300)] + ["onlyonce"]
    rows = [(i if i % 3 else None, t) for i, t in enumerate([*texts, "secret=hidden99 outside"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    random_steps, ordinary = [0.0] * secrets.SIZE**2, [0.0] * secrets.SIZE**2
    for counts, values in ((random_steps, ["hidden99"]), (ordinary, [w for t in texts[:-1] for w in t.split() if len(w) > 1])):
        for w in values:
            for a, b in zip(w, w[1:]):
                counts[ord(a) * secrets.SIZE + ord(b)] += 1
    found = secrets.scan(docs).select("doc_id", "_found.base", "_found.tokens")
    assert secrets.train(found, docs) == secrets.ratio_table(random_steps, ordinary)
    labels = spark.range(20_050).selectExpr("id AS doc_id", "1 AS quality")
    assert quality_rules.trusted_ids(labels).count() == 20_050


def test_mix(spark):
    sizes = {"b": 40, "a": 300, None: 30, "c": 3, "d": 0}
    texts, sources = [], []
    for s, n in sizes.items():
        for _ in range(20):
            texts.append("w " * n if s != "d" else None)
            sources.append(s)
    docs = corpus(spark, texts, sources)
    rows = mixing.mix(docs).collect()
    order = ["a", "b", "c", "d", None]
    have = {s: 20 * sizes[s] for s in order}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = sum(have.values()) - sum(3 * have[s] for s in capped)
        rest = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * have[s] if s in capped else weight[s] * left / rest for s in order}
        over = {s for s in order if target[s] > 3 * have[s]}
        if not over:
            break
        capped |= over
    for r in rows:
        assert r.target == pytest.approx(target[r.doc.source]) and r.source_size == have[r.doc.source]
        assert 0 <= r.copies <= 3
    again = {r.doc.doc_id: r.copies for r in mixing.mix(docs).collect()}
    assert again == {r.doc.doc_id: r.copies for r in rows}
    assert mixing.mixture(docs).count() == sum(again.values())


def test_url_filters(spark):
    import datetime as dt

    day = lambda m, d=1: dt.datetime(2024, m, d)
    entries = spark.createDataFrame(
        [
            ("e1", "example.com", "block", day(2)),
            ("e2", "example.com", "retire", day(5)),
            ("e3", "Good.example.com", "allow", day(3)),
            ("e4", "other.net/ads", "block", day(1)),
            ("e5", "example.com", "block", day(5)),
            ("e6", None, "block", day(1)),
            ("e7", "late.org", "block", None),
        ],
        "entry_id string, key string, action string, dated_at timestamp_ntz",
    )
    urls = [
        (1, "http://www.example.com/x", day(1, 15), False),
        (2, "https://user@www.EXAMPLE.com.:8080/x?a#b", day(2), True),
        (3, "http://good.example.com/", day(4), False),
        (4, "http://a.good.example.com/", day(2, 20), True),
        (5, "http://other.net/ads/1", day(6), True),
        (6, "http://other.net/adsx", day(6), False),
        (7, None, day(6), False),
        (8, "not a url", day(6), False),
        (9, "http://x.example.com", None, False),
        (10, "http://x.example.com", day(9), False),
        (10, "http://x.example.com", day(9), False),
    ]
    captures = spark.createDataFrame([u[:3] for u in urls], "page_id int, url string, fetched_at timestamp_ntz")
    got = {r.page_id: r for r in url_filters.url_filter(captures, entries).collect()}
    assert len(got) == 10 and {i: got[i].blocked for i, _, _, _ in urls} == {i: b for i, _, _, b in urls}
    assert got[3].entry_id == "e3" and got[5].matched_key == "other.net/ads"


def labelled(spark, good, bad, label):
    texts = [t for pair in zip(good, bad, strict=True) for t in pair]
    docs = corpus(spark, [*texts, None, ""])
    rows = [(i, 1 - i % 2 if label == "quality" else i % 2) for i in range(len(texts))]
    return docs, spark.createDataFrame([*rows, (None, 1)], f"doc_id bigint, {label} int")


def test_quality_classifier(spark):
    rng = random.Random(1)
    words = ["thing", "other", "reach", "over", "stand", "little", "more"]
    good = [" ".join(rng.choices(words, k=60)).capitalize() + "." for _ in range(60)]
    bad = [" | ".join(w.upper() + "%%%" for w in rng.choices(words, k=60)) for _ in range(60)]
    docs, labels = labelled(spark, good, bad, "quality")
    model = quality_classifier.learn(docs, labels)
    got = {r.doc_id: r.score for r in quality_classifier.score_quality(docs, model).collect()}
    assert len(got) == 122 and all(0 <= s <= 1 for s in got.values())
    assert sum((got[i] >= 0.7) == (i % 2 == 0) for i in range(120)) >= 118
    none = quality_classifier.learn(docs, labels.limit(0))
    assert {r.score for r in quality_classifier.score_quality(docs, none).collect()} == {0.5}


def test_toxicity(spark):
    rng = random.Random(3)
    syllables = ["th", "ea", "re", "on", "er", "ing", "st", "an", "ou", "ly"]
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(300)]
    clean = [" ".join(rng.choices(words, k=40)) for _ in range(80)]
    foul = []
    for _ in range(80):
        text = rng.choices(words, k=40)
        text[rng.randrange(40)] = rng.choice(["idiot", "moron", "scumbag"])
        foul.append(" ".join(text))
    docs, labels = labelled(spark, clean, foul, "toxic")
    model = toxicity.learn(docs, labels)
    more = ["what an i-d-i-o-t here", "you m$o$r$o$n there", "the thing on ear", None, ""]
    got = {r.doc_id: r.toxicity for r in toxicity.score_toxicity(docs, model).collect()}
    assert sum((got[i] >= 0.7) == (i % 2 == 1) for i in range(160)) >= 156
    extra = {r.doc_id: r.toxicity for r in toxicity.score_toxicity(corpus(spark, more), model).collect()}
    assert extra[0] >= 0.7 and extra[1] >= 0.7 and max(extra[2], extra[3], extra[4]) < 0.7


def test_capped_samples_keep_the_label_shares(spark, monkeypatch):
    rng = random.Random(4)
    words = ["thing", "other", "reach", "over", "stand", "little", "more"]
    texts = [" ".join(rng.choices(words, k=12) + ["idiot"] * (i % 8 == 0)) for i in range(320)]
    docs = corpus(spark, texts)
    labels = spark.createDataFrame(
        [(i, i % 8 > 0, i % 8 == 0) for i in range(320)], "doc_id bigint, quality boolean, toxic boolean"
    ).selectExpr("doc_id", "int(quality) AS quality", "int(toxic) AS toxic")
    quality = quality_classifier.learn(docs, labels, most=10)
    trained = [i for i in range(320) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert quality.prior == pytest.approx(sum(i % 8 > 0 for i in trained) / len(trained))
    blank = quality_classifier.score_quality(corpus(spark, [None, ""]), quality).collect()
    assert [r.score for r in blank] == [pytest.approx(quality.prior)] * 2
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic, totals=None: (Counter(toxic), totals))
    trained = [i % 8 > 0 for i in range(320) if zlib.crc32(str(i).encode()) % 3 != 1]
    sampled, totals = toxicity.learn(docs, labels, most=10)
    assert sampled == {0: 10, 1: 10} and totals == (sum(trained), len(trained) - sum(trained))
    x = np.array([0.0, 1, 2, 3, 0.5, 1.5, 2.5, 3.5])
    y = np.array([0, 0, 0, 0, 1, 1, 1, 1])
    whole = toxicity.logistic(np.tile(x, 500), np.tile(y, 500))
    assert toxicity.logistic(x, y, (2000, 2000)) == toxicity.logistic(x, y)
    slope, bias = toxicity.logistic(np.tile(x, 500), np.tile(y, 500), (8000, 1000))
    assert slope == pytest.approx(whole[0], rel=0.1) and bias == pytest.approx(whole[1] - np.log(8), abs=0.2)


def test_empty_tables(spark):
    docs = corpus(spark, ["x"]).limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert substring_dedup.remove_repeated_words(docs).count() == 0
    assert suffix_dedup.remove_repeated_bytes(docs).count() == 0
    assert jaccard_join.similar_groups(docs).count() == 0
    assert decontaminate.decontaminate(docs, bench).count() == 0
    assert quality_rules.quality_rules(docs, quality_rules.trusted_ids(labels)).count() == 0
    assert secrets.find_secrets(docs).count() == 0 and mixing.mixture(docs).count() == 0
    assert quality_classifier.score_quality(docs, quality_classifier.learn(docs, labels)).count() == 0
    assert toxicity.score_toxicity(docs, toxicity.learn(docs, labels)).count() == 0
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert url_filters.url_filter(url_filters.captures_of(pages), url_filters.entries_of(pages)).count() == 0


def test_empty_benchmark_and_hash_of_nothing(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    rows = decontaminate.decontaminate(corpus(spark, ["a b", None]), bench).collect()
    assert {(r.n_words, r.n_hit) for r in rows} == {(2, 0), (0, 0)}


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096])
def test_long_words_of_like_sums_differ(spark, n):
    """Words whose power sums modulo 2**64 are equal are different words everywhere."""
    one, two = thue_morse(n, "ab"), thue_morse(n, "ba")
    rest = " ".join(f"r{i}" for i in range(19))
    docs = corpus(spark, [f"{one} {rest}", f"{two} {rest}"])
    assert [r.n_removed for r in substring_dedup.remove_repeated_words(docs).collect()] == [0, 0]
    alone = corpus(spark, [one, two, one])
    groups = {r.doc_id: r.component_id for r in jaccard_join.similar_groups(alone, 3, 90).collect()}
    assert groups == {0: 0, 1: 1, 2: 0}
    items = spark.createDataFrame([("i", two)], "item_id string, text string")
    hits = {r.doc_id: r.n_hit for r in decontaminate.decontaminate(alone, items).collect()}
    assert hits == {0: 0, 1: 1, 2: 0}
    # The same with words in that order.
    words = [thue_morse(n, ("x ", "y ")), thue_morse(n, ("y ", "x "))]
    groups = jaccard_join.similar_groups(corpus(spark, words), n, 90).collect()
    assert {r.component_id for r in groups} == {0, 1}


def test_names_of_stretches():
    rng = np.random.default_rng(8)
    symbols = rng.integers(0, 3, 300).astype(np.uint64)
    names = arrays.Doubled(symbols)
    start = rng.integers(0, 260, 2000)
    end = start + rng.integers(0, 41, 2000)
    found = names.of(start, end)
    meant = {}
    for a, b, name in zip(start.tolist(), end.tolist(), found.tolist(), strict=True):
        assert meant.setdefault(name, tuple(symbols[a:b])) == tuple(symbols[a:b])
    assert len(meant) == len({tuple(symbols[a:b]) for a, b in zip(start, end, strict=True)})


def test_quality_rules_by_broadcast_and_by_shuffle(spark, texts):
    """The ratios are the same whichever way texts meet the trusted ids, NULL ids included."""
    docs = corpus(spark, texts).unionByName(spark.createDataFrame([(None, "no id", "en", "s", 5, 1, None)], SCHEMA))
    trusted = spark.createDataFrame([(i,) for i in range(0, len(texts), 2)], "doc_id bigint")
    one, two = (quality_rules.gram_ratios(docs, trusted, 512, most) for most in (quality_rules.MOST_BROADCAST, 0))
    assert one == two and len(set(one)) > 3


ORDINARY_STRINGS = [
    "usr/local/lib/python3/dist-packages", "com/google/android/gms/common", "correct-horse-battery-staple",
    "getHTTPResponseCodeFromServer", "-" * 30, "=" * 20, "articles/2021/05/12/how-to-cook-rice",
    "InternationalizationHelper", "z" * 24, "0" * 20, "A" * 40, "TransactionManagerFactoryBean", "CONSTANT_NAME_OF_VALUE",
    "20210512123456", "src/main/java/org/example/AbstractBaseServiceImpl.java",
]


@pytest.fixture(scope="module")
def english(spark):
    """Ordinary text, with a few secrets that teach the other model."""
    words = (
        "the response of every server is written to a local file and read again when common code asks for it please note "
        "that packages for the distribution are built from source each night while helpers translate names into other "
        "languages where transactions manage their own state factories make beans horses eat rice staple goods and battery "
        "cells are cooked later international readers find articles about android phones google searches and python paths"
    ).split()
    rng = random.Random(2)
    texts = [" ".join(rng.choices(words, k=60)).capitalize() + " In 2021 and 1999." for _ in range(300)]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    return texts + ["token=" + "".join(rng.choices(letters, k=24)) for _ in range(40)]


def test_random_strings_and_ordinary_ones(spark, english):
    """Names, paths and rules stay; random strings of 16 and more characters are found."""
    rng = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    planted = ["".join(rng.choices(letters, k=rng.choice([16, 20, 24, 32]))) for _ in range(200)]
    texts = english + [f"see {s} there" for s in ORDINARY_STRINGS] + [f"use {s} here" for s in planted]
    got = {r.doc_id: [s.rank for s in r.spans] for r in secrets.find_secrets(corpus(spark, texts)).collect()}
    at = len(english)
    flagged = [s for i, s in enumerate(ORDINARY_STRINGS) if got[at + i]]
    assert flagged == []
    found = sum(got[at + len(ORDINARY_STRINGS) + i] == [3] for i in range(200))
    assert found >= 190  # recall of 0.95
    assert not any(3 in got[i] for i in range(300))


def test_runs_beside_base_spans(spark, english):
    """What a base span leaves of a run is judged alone; positions are those of the text."""
    tail, head = "x9Kq2Zr7Lm4Wp8Tn", "Qw7Zx2Kp9Lm4Rt8Y"
    texts = english + [f"é AKIA{'QWERTYUIOPASDFGH'}{tail.lower()[:4]} and {head}{'0a1b2c3d' * 3} {'é' * 3}{tail}", tail * 3_000]
    got = {r.doc_id: r for r in secrets.find_secrets(corpus(spark, texts)).collect()}
    first = got[len(english)]
    text = texts[len(english)]
    spans = {(s.rank, text[s.start : s.end]) for s in first.spans}
    assert (3, tail) in spans and (3, head) in spans and (2, "0a1b2c3d" * 3) in spans
    assert [(s.rank, s.start, s.end) for s in got[len(english) + 1].spans] == [(3, 0, 48_000)]


def test_places_are_sums_of_blocks(spark):
    df = spark.createDataFrame([([int(x) for x in range(n)],) for n in (0, 1, 2, 7, 8, 9, 64, 65, 200)], "v array<int>")
    got = df.select("v", secrets.running(F.col("v"), 8).alias("s")).collect()
    assert all(r.s == [sum(r.v[:i]) for i in range(len(r.v))] for r in got)


def test_toxicity_learns_every_insult_of_a_text_and_whole_texts(spark):
    """Insults that always stand beside a more frequent one are learnt, from texts of any length."""
    rng = random.Random(11)
    words = ["".join(rng.choices("aeou", k=1) + rng.choices("lnrst", k=1) + rng.choices("aeou", k=2)) for _ in range(300)]
    clean = [" ".join(rng.choices(words, k=40)) for _ in range(80)]
    foul = [" ".join(rng.choices(words, k=40) + ["idiot"] + ["scumbag"] * (i % 3 == 0)) for i in range(80)]
    foul[0] = " ".join(rng.choices(words, k=8000) + ["idiot", "scumbag"])
    docs, labels = labelled(spark, clean, foul, "toxic")
    model = toxicity.learn(docs, labels)
    data, cuts = toxicity.flat(["the scumbag here", foul[0], clean[0]])
    high = model.score(data, cuts)
    assert high[0] >= 0.7 and high[1] >= 0.7 and high[2] < 0.7


def test_logistic_curve_with_an_outlier():
    """Labels that are all but separate, beside a value far out, still give a rising curve."""
    x = np.array([0.1, 0.2, 0.15, 0.3, 2.0, 2.1, 1.9, 90.0])
    y = np.array([0, 0, 0, 0, 1, 1, 1, 0])
    slope, bias = toxicity.logistic(x[:-1], y[:-1])
    assert slope * 2.0 + bias > 1 and slope * 0.2 + bias < -1
    far = toxicity.logistic(x, y)
    assert np.isfinite(far).all()


def test_kernel_is_the_sum_over_shared_triples():
    """Columns of two words multiply to the kernel of its definition."""
    from itertools import combinations

    def features(word):
        codes = [toxicity.START, *(int(c) for c in toxicity.CODES[np.frombuffer(word.encode(), np.uint8)])]
        out = Counter()
        for a, b, c in combinations(range(len(codes)), 3):
            if c - a < toxicity.SPAN:
                out[codes[a], codes[b], codes[c]] += toxicity.DECAY ** (c - a + 1)
        return out, len(codes)

    words = ["idiot", "idxiot", "moron", "no", "banana"]
    columns = toxicity.triple_table(words).astype(float)
    for i, one in enumerate(words):
        for j, two in enumerate(words):
            (f, n), (g, m) = features(one), features(two)
            size = toxicity.norms(np.array([n, m]))
            expected = sum(v * g[t] for t, v in f.items()) / size[0] / size[1]
            assert columns[:, i] @ columns[:, j] == pytest.approx(expected, rel=1e-4)


def test_rows_without_an_id_do_not_depend_on_their_files(spark):
    """The same of several NULL-id rows loses its passage however the rows are split; lengths out of range raise."""
    shared = " ".join(f"s{i}" for i in range(25))
    texts = [f"{shared} tail {i} " + " ".join(f"t{i}_{j}" for j in range(i)) for i in range(12)] + [shared, shared, None]
    rows = [(None, t) for t in texts]

    def result(some, parts):
        docs = spark.createDataFrame(some, "doc_id bigint, text string").repartition(parts)
        got = substring_dedup.remove_repeated_words(docs).collect()
        return sorted((r.n, r.n_removed, r.kept) for r in got)

    one = result(rows, 1)
    assert result(rows[::-1], 5) == one and sum(r[1] == 0 for r in one) == 2
    for wrong in (8, 40_000):
        with pytest.raises(ValueError):
            suffix_dedup.remove_repeated_bytes(corpus(spark, ["x"]), wrong)
