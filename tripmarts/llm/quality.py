"""Quality rules in DataFrame operations: base rules, then a likelihood ratio of hashed n-grams.

Words, their endings and pairs of neighbouring words are hashed to buckets. Two multinomials, one of
trusted documents and one of the whole corpus, give each n-gram a log-likelihood ratio; words with
endings have buckets and shares of their own, and so have pairs. A document's score is the lower of
two means, the one over its words and endings and the one over its pairs, so that neither good words
in a bad order nor known pairs of bad words pass. Documents below a fixed threshold go.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmarts.llm.common import words

BUCKETS = 1 << 14
# Buckets of word pairs, which are more than words.
PAIR_BUCKETS = 1 << 16
# Added to every bucket count of both multinomials.
SMOOTHING = 1.0
# Added to every bucket count of pairs, once the trusted counts are brought to the size of the corpus: pairs
# are rare in small tables, and a rare pair shall tell little.
PAIR_SMOOTHING = 10.0
# Least mean log-likelihood ratio of a document that is kept.
THRESHOLD = -0.6
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
SYMBOLS = "[#*$%&|<>]"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Characters at the end of a word that count as one n-gram.
ENDING = 3
# Trusted documents that serve at most; the corpus counts have no bound.
TRUSTED_ROWS = 20_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(hashes: Column, window: int = WINDOW) -> Column:
    """Words in windows that occur twice or more, from the hashes of the text's words.

    Equal windows are those with equal 64-bit hashes.
    """
    starts = F.size(hashes) - window + 1
    every = F.transform(hashes, lambda x, i: F.xxhash64(x, *(F.get(hashes, i + n) for n in range(1, window))))

    def covered(windows: Column) -> Column:
        # Places in order of their window's hash: equal neighbours are repeats.
        places = F.sort_array(F.transform(windows, lambda hashed, i: F.struct(hashed.alias("hash"), i.alias("at"))))
        repeats = let(places, lambda places: F.filter(
            places,
            lambda x, i: (x["hash"] == F.get(places, i - 1)["hash"]) | (x["hash"] == F.get(places, i + 1)["hash"]),
        ))
        ordered = F.sort_array(F.transform(repeats, lambda x: x["at"]))
        return F.aggregate(
            ordered,
            F.struct(F.lit(0).alias("total"), F.lit(-window).alias("last")),
            lambda held, at: F.struct(
                (held["total"] + F.least(F.lit(window), at - held["last"])).alias("total"), at.alias("last")
            ),
            lambda held: held["total"],
        )

    counted = let(
        F.slice(every, 1, starts),
        lambda windows: F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered(windows)),
    )
    return F.when(starts < 2, F.lit(0)).otherwise(counted).cast("long")


def base_measures(text: Column, listed: Column, hashes: Column) -> dict[str, Column]:
    """Base measures of a text, given its words and their hashes."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    measures = {
        "n_words": F.size(listed),
        "word_chars": F.char_length(F.array_join(listed, "")),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeated_words(hashes),
    }
    return {name: measure.cast("long") for name, measure in measures.items()}


def word_buckets(word: Column, buckets: int = BUCKETS) -> list[Column]:
    """Buckets of a word's n-grams: of the word itself and of its last characters."""
    ending = F.substring(word, -ENDING, ENDING)
    return [F.pmod(hashed, F.lit(buckets)).cast("int") for hashed in (F.xxhash64(word), F.xxhash64(ending, F.lit(ENDING)))]


def pair_bucket(before: Column, hashed: Column, pair_buckets: int = PAIR_BUCKETS) -> Column:
    """Bucket of two neighbouring words, from their hashes; all words that repeat their neighbour share one."""
    return F.pmod(F.when(before == hashed, F.xxhash64(F.lit("="))).otherwise(F.xxhash64(before, hashed)), F.lit(pair_buckets)).cast("int")


def pairs_of(hashes: Column, pair_buckets: int = PAIR_BUCKETS) -> Column:
    """Buckets of the pairs of a text, from the hashes of its words."""
    return F.transform(
        F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))), lambda x, i: pair_bucket(F.get(hashes, i), x, pair_buckets)
    )


def log_ratios(
    documents: DataFrame, trusted: DataFrame, *, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
    pair_buckets: int = PAIR_BUCKETS, smoothing: float = SMOOTHING, trusted_rows: int = TRUSTED_ROWS,
) -> DataFrame:
    """One row, columns ``ratios`` and ``pair_ratios``: per bucket log(trusted share / corpus share).

    Without pairs in trusted documents all ratios of pairs are 0.
    The corpus counts are those of all documents. ``trusted`` names the trusted documents by key;
    repeated and NULL keys add nothing. Of more than ``trusted_rows`` those with the smallest key
    hashes serve, so that the marks fit a broadcast and no text is shuffled.
    """
    marks = trusted.select(F.col(key).alias("trusted_id")).filter("trusted_id IS NOT NULL").distinct()
    marks = marks.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(trusted_rows)
    rows = documents.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(marks), F.col("doc_id") == F.col("trusted_id"), "left")

    def n_grams(listed: Column) -> Column:
        single = F.flatten(F.transform(listed, lambda word: F.array(*word_buckets(word, buckets))))
        hashes = F.transform(listed, lambda word: F.xxhash64(word))
        pairs = let(hashes, lambda hashes: F.transform(pairs_of(hashes, pair_buckets), lambda x: x + F.lit(buckets)))
        return F.concat(single, pairs)

    # Buckets of pairs are numbered behind those of words.
    rows = rows.select("trusted_id", F.explode(let(words(F.col("text")), n_grams)).alias("bucket"))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("corpus"), F.count("trusted_id").alias("trusted"))
    # As many rows as there are buckets, whatever the corpus.
    every = documents.sparkSession.range(buckets + pair_buckets).select(F.col("id").cast("int").alias("bucket"))
    every = every.join(counts, "bucket", "left").fillna(0, ["corpus", "trusted"])
    single = F.col("bucket") < buckets
    listed = every.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "corpus", "trusted"))).alias("held"),
        *(F.sum(F.when(single, F.col(name)).otherwise(0)).alias(f"word_{name}") for name in ("corpus", "trusted")),
        *(F.sum(F.when(single, 0).otherwise(F.col(name))).alias(f"pair_{name}") for name in ("corpus", "trusted")),
    )

    def share(count: Column, total: str) -> Column:
        return (count + smoothing) / (F.col(total) + smoothing * buckets)

    def ratio(found: Column) -> Column:
        return F.log(share(found["trusted"], "word_trusted") / share(found["corpus"], "word_corpus"))

    def pair_ratio(found: Column) -> Column:
        scaled = F.try_divide(found["trusted"] * F.col("pair_corpus"), F.col("pair_trusted"))
        told = F.log((scaled + PAIR_SMOOTHING) / (found["corpus"] + PAIR_SMOOTHING))
        return F.when(F.col("pair_trusted") > 0, told).otherwise(F.lit(0.0))

    return listed.select(
        F.transform(F.slice("held", 1, buckets), ratio).alias("ratios"),
        F.transform(F.slice("held", buckets + 1, pair_buckets), pair_ratio).alias("pair_ratios"),
    )


def fitted_ratios(documents: DataFrame, trusted: DataFrame, **options) -> tuple[Column, Column]:
    """:func:`log_ratios` as literals of numbers, of words and of pairs: functions of array elements hold no subquery."""
    ratios = log_ratios(documents, trusted, **options)
    row = ratios.select(
        *(F.array_join(F.transform(name, lambda x: x.cast("string")), ",") for name in ("ratios", "pair_ratios"))
    ).first()
    return tuple(F.split(F.lit(listed), ",").cast("array<double>") for listed in row)


def verdict(
    text: Column, fitted: tuple[Column, Column], *, buckets: int = BUCKETS, pair_buckets: int = PAIR_BUCKETS,
    threshold: float = THRESHOLD,
) -> tuple[Column, Callable]:
    """A struct of a text's measures, and what makes the result's columns of that struct.

    The struct is one expression, so that no array of words becomes a column.
    """
    text = F.coalesce(text, F.lit(""))
    ratios, pair_ratios = fitted

    def measured(listed: Column) -> Column:
        total = F.aggregate(
            listed,
            F.lit(0.0),
            lambda held, word: sum((ratios[bucket] for bucket in word_buckets(word, buckets)), held),
        )
        hashes = F.transform(listed, lambda word: F.xxhash64(word))

        def of_hashes(hashes: Column) -> Column:
            pairs = F.aggregate(pairs_of(hashes, pair_buckets), F.lit(0.0), lambda held, bucket: held + pair_ratios[bucket])
            base = F.struct(*(measure.alias(name) for name, measure in base_measures(text, listed, hashes).items()))
            return F.struct(base.alias("base"), pairs.alias("pairs"))

        return F.struct(let(hashes, of_hashes).alias("hashed"), total.alias("total"))

    def columns(made: Column) -> dict[str, Column]:
        base = {name: made["hashed"]["base"][name] for name in MEASURES}
        n, repeated = base["n_words"], base["n_repeat_words"]
        failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)
        single = made["total"] / (2 * n)
        score = F.when(n > 1, F.least(single, made["hashed"]["pairs"] / (n - 1)))
        score = score.when(n == 1, single).otherwise(F.lit(0.0))
        return base | {"base_failed": failed, "score": score, "kept": ~failed & (score >= threshold)}

    return let(words(text), measured), columns


def quality_scores(
    documents: DataFrame, trusted: DataFrame, *, key: str = "doc_id", text: str = "text",
    buckets: int = BUCKETS, smoothing: float = SMOOTHING, trusted_rows: int = TRUSTED_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id``, the base measures, ``base_failed``, ``score`` and ``kept`` of every document.

    The score is the lower mean log-likelihood ratio, of words with their endings or of pairs of
    neighbouring words; one word alone has no pair. A NULL text has no words, and texts without words score 0. Documents that fail the base rules are not kept, the
    others are kept from a score of ``threshold`` on. Equal texts get equal scores; rows with equal
    or NULL keys are kept apart. Other columns are not read; an empty table gives an empty result.
    """
    ratios = fitted_ratios(
        documents, trusted, key=key, text=text, buckets=buckets, smoothing=smoothing, trusted_rows=trusted_rows
    )
    made, columns = verdict(F.col(text), ratios, buckets=buckets, threshold=threshold)
    rows = documents.select(F.col(key).alias("doc_id"), made.alias("made"))
    return rows.select("doc_id", *(value.alias(name) for name, value in columns(F.col("made")).items()))


def keep_good(
    documents: DataFrame, trusted: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents that :func:`quality_scores` keeps, with all their columns."""
    ratios = fitted_ratios(documents, trusted, key=key, text=text)
    made, columns = verdict(F.col(text), ratios, threshold=threshold)
    # Bound to a variable, as a filter that names a column repeats its whole expression.
    return documents.filter(let(made, lambda made: columns(made)["kept"]))
