"""Quality rules, SimHash, toxicity and token files against plain versions of the same."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tripmarts.llm import quality, simhash, toxicity, wavelet
from tripmarts.llm.common import ship
from tripmarts.runtime import work_path

WORD = re.compile("[^\x20\x09-\x0d]+")
PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = "long text of many words that differ " + " ".join(f"w{n % 977}x{n % 31}" for n in range(30_000))
TEXTS = [
    None, "", " \n\t ", "one", "ONE", "a b c d", "a b c d e f", "x y z u v w x y z u v w x y z u v", LONG, LONG, LONG + " end",
    "same line here\nsame line here\n\n  \nother | line <b> & $5 %\nsame line here", "tab\tand\x0bvertical\x1cfile\x85next",
    "the quick brown fox jumps over the lazy dog and runs away from here to there", "é ä ñ — “quoted” 漢字 😀 İ Σ ΑΣ",
]


@pytest.fixture(scope="module")
def documents(spark):
    ship(spark)
    rows = [(n, text, f"src{n % 3}", None, 1.0) for n, text in enumerate(TEXTS)]
    rows += [(3, "one", None, None, None), (None, "a b c d", "src1", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, score double")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(n, n % 2, int(n == 7)) for n in range(len(TEXTS))] + [(None, 1, 1), (2, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[n : n + 5]) for n in range(len(words) - 4)]
    counts = {}
    for window in windows:
        counts[window] = counts.get(window, 0) + 1
    covered = {n + k for n, window in enumerate(windows) if counts[window] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
    )


def test_quality_measures(spark, documents, labels):
    good = labels.filter("quality = 1").select("doc_id")
    rows = quality.quality_scores(documents, good).collect()
    assert len(rows) == documents.count()
    source = {row.doc_id: row.text for row in documents.collect() if row.doc_id is not None}
    for row in rows:
        text = source.get(row.doc_id, "a b c d")
        n_words, *rest = plain_measures(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (n_words, *rest), text
        assert row.base_failed == (n_words < 10 or 100 * rest[-1] > 20 * n_words)
        assert not (row.kept and row.base_failed)


def test_quality_ratios_are_shares(spark):
    ship(spark)
    rows = [(n, "good plain words here" if n < 50 else "bad### stuff### here###") for n in range(100)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = documents.filter("doc_id < 40").select("doc_id")
    ratios = quality.log_ratios(documents, trusted, buckets=1 << 12).first().ratios
    assert len(ratios) == 1 << 12
    word = spark.range(1).select(*quality.word_buckets(F.lit("good"), 1 << 12)).first()
    # 40 of 40 * 8 trusted n-grams against 50 of 50 * 8 + 50 * 6.
    assert ratios[word[0]] == pytest.approx(np.log((41 / (320 + 4096)) / (51 / (700 + 4096))), rel=0.05)
    scores = {row.doc_id: row.score for row in quality.quality_scores(documents, trusted, buckets=1 << 12).collect()}
    assert min(scores[n] for n in range(50)) > max(scores[n] for n in range(50, 100))


def test_keep_good_keeps_columns(spark, documents, labels):
    good = labels.filter("quality = 1").select("doc_id")
    kept = quality.keep_good(documents, good)
    assert kept.columns == documents.columns
    expected = quality.quality_scores(documents, good).filter("kept").count()
    assert kept.count() == expected


def plain_fingerprint(text, spark_hash):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[n : n + 4]) for n in range(max(1, len(words) - 3))]
    hashes = [spark_hash(shingle) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints):
    label = list(range(len(fingerprints)))

    def find(n):
        while label[n] != n:
            n = label[n]
        return n

    for a in range(len(fingerprints)):
        for b in range(a):
            if (fingerprints[a] ^ fingerprints[b]).bit_count() <= 4:
                label[find(a)] = find(b)
    return [find(n) for n in range(len(fingerprints))]


def test_simhash_matches_brute_force(spark, documents):
    from xxhash import xxh64_intdigest

    rows = simhash.near_duplicates(documents).collect()
    source = documents.collect()
    assert len(rows) == len(source)
    expected = [plain_fingerprint(row.text, lambda s: xxh64_intdigest(s.encode(), 42)) for row in source]
    groups = plain_components(expected)
    lowest = {}
    for row, group in zip(source, groups, strict=True):
        if row.doc_id is not None:
            lowest[group] = min(row.doc_id, lowest.get(group, row.doc_id))
    wanted = sorted((str(r.doc_id), f"{fp:016x}", lowest.get(g)) for r, fp, g in zip(source, expected, groups, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in rows) == wanted


@pytest.mark.parametrize("segments", [1, 2, 3, 4, 5])
@pytest.mark.parametrize("block", [8192, 4])
def test_links_find_every_component(spark, segments, block):
    if segments == 1:
        pytest.skip("the ball of a whole fingerprint is too large to list")
    ship(spark)
    draw = np.random.default_rng(segments)
    centres = draw.integers(0, 1 << 62, 12)
    values = {int(c) for c in centres} | {0}
    for centre in centres.tolist() * 6:
        flips = draw.choice(63, draw.integers(1, 6), replace=False)
        values.add(int(centre) ^ sum(1 << int(bit) for bit in flips))
    values = sorted(values)
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    found = simhash.links(distinct, segments=segments, block=block).collect()
    assert all((row.a ^ row.b).bit_count() <= 4 for row in found)
    label = {v: v for v in values}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    for row in found:
        label[find(row.a)] = find(row.b)
    groups = plain_components(values)
    assert len({find(v) for v in values}) == len(set(groups))


def test_one_of_each_group_stays(spark, documents):
    left = simhash.drop_near_duplicates(documents)
    assert left.columns == documents.columns
    ids = sorted(row.doc_id for row in left.collect() if row.doc_id is not None)
    groups = {row.component_id for row in simhash.near_duplicates(documents).collect() if row.component_id is not None}
    assert ids == sorted(groups)


def test_toxicity_learns_stems():
    draw = np.random.default_rng(0)
    plain = [f"{a}{b}" for a in ("th", "er", "on", "st") for b in ("ing", "er", "ed", "ly", "ion")]
    bad = ["badlo", "badly", "badon", "baden", "clownish"]

    def text(toxic, stems):
        words = [plain[i] for i in draw.integers(0, len(plain), 40)]
        if toxic:
            words[int(draw.integers(0, 40))] = stems[int(draw.integers(0, len(stems)))]
        return words

    rows = [(text(n % 3 == 0, bad), int(n % 3 == 0)) for n in range(450)]
    windows = [[words[s : s + toxicity.WINDOW] for s in toxicity.window_starts(len(words))] for words, _ in rows]
    model = toxicity.train(windows, [label for _, label in rows])
    scorer = toxicity.Scorer(model)
    fresh = [(text(n % 2 == 0, ["badum", "badit", *bad]), n % 2 == 0) for n in range(200)]
    scores = scorer.scores([" ".join(words) for words, _ in fresh])
    right = sum((s >= toxicity.CUTOFF) == label for s, (_, label) in zip(scores, fresh, strict=True))
    assert right >= 180
    assert scorer.scores([None, ""])[0] == scorer.scores(["  "])[0]


def test_windows_cover_whole_texts():
    for length in (0, 1, 31, 32, 33, 48, 49, 1000):
        starts = toxicity.window_starts(length)
        covered = {n for s in starts for n in range(s, min(length, s + toxicity.WINDOW))}
        assert covered == set(range(length))
        assert all(s == 0 or s < length for s in starts)


def test_gradients_match_differences():
    model = {k: v.astype(np.float64) for k, v in toxicity.new_model(3).items()}
    features = toxicity.word_features(["alpha", "beta", "gamma!", "DELTA"])
    index = np.array([[0, 1], [2, 3], [1, 0]])
    mask = np.array([[1, 1], [1, 1], [1, 0]], np.float64)
    labels, weights = np.array([1.0, 0.0]), np.ones(2)
    grads = toxicity.gradients(model, features, index, mask, labels, weights)

    def loss(model):
        vectors = np.concatenate([model["words"][features[0]], toxicity.gram_means(model["grams"], *features[1:])], axis=1)
        gates = [vectors[index] @ model[f"w{s}"] + model[f"c{s}"] for s in "fb"]
        logits = toxicity.forward(model, *gates, mask)
        return np.mean(np.logaddexp(0, logits) - labels * logits)

    for name in ("uf", "ub", "wf", "cb", "attend", "out", "bias"):
        at = tuple(0 for _ in model[name].shape)
        moved = [dict(model), dict(model)]
        for sign, one in zip((1, -1), moved, strict=True):
            one[name] = model[name].copy()
            one[name][at] += sign * 1e-3
        numeric = (loss(moved[0]) - loss(moved[1])) / 2e-3
        assert grads[name][at] == pytest.approx(numeric, rel=0.05, abs=1e-4), name


def test_toxicity_query_shape(spark, documents, labels):
    model = toxicity.fit(documents, labels)
    rows = toxicity.toxicity(documents, model).collect()
    assert len(rows) == documents.count()
    for row in rows:
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7)
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
    kept = toxicity.drop_toxic(documents, model)
    assert kept.columns == documents.columns
    assert kept.count() == sum(not row.predicted for row in rows)


def test_coder_equals_tokenizer():
    coder = wavelet.Coder(PATH)
    odd = ["Don't stop!! I'LL 12²½ ''s x'RE", "a b\x1cc\x85d\xa0e", "<|endoftext|> ok", "é é ﬁ", "Ǆ ǅ ſ ẞ"]
    texts = [text or "" for text in TEXTS] + odd
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert ids.tolist() == coder.whole.encode(text, add_special_tokens=False).ids, text[:50]


def test_wavelet_matrix_answers():
    ids = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint16)
    matrix = wavelet.WaveletMatrix.build(ids, 9)
    again, doc_ids, ends, _ = wavelet.from_file(wavelet.to_file(matrix, [5, None], np.array([2000, 5000])) + b"\n")
    assert doc_ids == [5, None] and ends.tolist() == [2000, 5000]
    assert (again.decode() == ids).all()
    for at in (0, 1, 511, 512, 4999):
        assert again.access(at) == ids[at]
    for token in (0, 7, 299, 511):
        places = np.flatnonzero(ids == token)
        assert again.count(token) == len(places)
        assert again.rank(token, 2500) == (places < 2500).sum()
        assert [again.select(token, n) for n in range(len(places))] == places.tolist()
        with pytest.raises(IndexError):
            again.select(token, len(places))
    assert again.count(1000) == 0


def test_wavelet_empty():
    matrix = wavelet.WaveletMatrix.build(np.zeros(0, np.uint16), 4)
    assert matrix.decode().tolist() == [] and matrix.count(3) == 0


def test_token_files(spark, documents):
    path = work_path(spark, "tokens")
    wavelet.write_shards(documents, path, PATH, shard_tokens=2000, shard_docs=4)
    rows = sorted(wavelet.read_documents(spark, path).collect(), key=lambda row: row.start)
    source = documents.collect()
    assert len(rows) == len(source)
    coder = wavelet.Coder(PATH)
    start, wanted = 0, {}
    for row in source:
        ids = [*coder.whole.encode(row.text or "", add_special_tokens=False).ids, 2]
        wanted.setdefault(row.doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert [row.doc_id for row in rows] == sorted((r.doc_id for r in source), key=lambda x: (x is not None, x or 0))
    for row in rows:
        assert row.start == start
        wanted[row.doc_id].remove((row.n_tokens, row.ids_crc32))
        start += row.n_tokens


def test_empty_tables(spark, documents, labels):
    none, no_labels = documents.limit(0), labels.limit(0)
    assert quality.quality_scores(none, no_labels.select("doc_id")).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0
    assert toxicity.toxicity(none, toxicity.fit(none, no_labels)).count() == 0
    path = work_path(spark, "none")
    wavelet.write_shards(none, path, PATH)
    assert wavelet.read_documents(spark, path).count() == 0
