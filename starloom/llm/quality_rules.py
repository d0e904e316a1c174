"""Quality rules: plain counts of words and lines, and a hashed n-gram likelihood ratio.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two
multinomials over the buckets, one of the trusted target texts and one of the whole raw
corpus, give each bucket the logarithm of the ratio of its two probabilities. A text's
score is the mean of its n-grams' logarithms, so that length plays no part, and every
text is kept or dropped by the same threshold, without chance.

DataFrame functions only. Texts never move: counting shuffles at most one row per bucket
and task, scoring one row of numbers per text. Logarithms are whole millionths, so that
sums don't depend on their order.
"""

from pyspark.sql import functions as F

BUCKET_BITS = 14
SMOOTHING = 1.0  # added to the count of every bucket
UNIT = 1_000_000
THRESHOLD = -0.06  # the smallest mean logarithm, in nats, of a text that is kept
MIN_WORDS = 50
MOST_REPEATED = 50  # percent of words in windows that repeat

# White space between words, and symbols.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = "#*$%&|<>"
SPLIT = r"[\x20\x09-\x0D]+"
WINDOW = 3

RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept")


def words_of(text):
    """The words of a text column; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPLIT, -1), "")


def without(text, characters):
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def grams(words):
    """A generator of the words, each with the next one (NULL for the last), as `g`."""
    pair = F.arrays_zip(words.alias("word"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))).alias("next"))
    return F.explode_outer(pair).alias("g")


def buckets_of(g, bits):
    """The buckets of a word and of the pair that it begins, from the generator's column."""
    word, after = g["word"], g["next"]
    return [F.shiftrightunsigned(d, 64 - bits).cast("int") for d in (
        F.when(word.isNotNull(), F.xxhash64(word)), F.when(after.isNotNull(), F.xxhash64(word, after)))]


def gram_counts(df, text="text", bits=BUCKET_BITS):
    """bucket and n: how many n-grams of all texts fall in each bucket that has any."""
    each = df.select(grams(words_of(F.col(f"`{text}`"))))
    both = each.select(F.explode(F.array(*buckets_of(F.col("g"), bits))).alias("bucket")).filter("bucket IS NOT NULL")
    return both.groupBy("bucket").agg(F.count("*").alias("n"))


def log_ratios(raw, target, text="text", bits=BUCKET_BITS, smoothing=SMOOTHING):
    """One row with the log ratios of the 2^bits buckets, in units of 1 / UNIT, as an array in their order.

    Without target texts, or without raw ones, they are what smoothing alone gives.
    """
    counted = raw.sparkSession.range(1 << bits).select(F.col("id").cast("int").alias("bucket"))
    for name, df in (("r", raw), ("t", target)):
        counted = counted.join(gram_counts(df, text, bits).withColumnRenamed("n", name), "bucket", "left")
    smooth = counted.select("bucket", *[(F.coalesce(c, F.lit(0)) + F.lit(float(smoothing))).alias(c) for c in ("r", "t")])
    # As many rows as there are buckets.
    every = smooth.agg(F.sort_array(F.collect_list(F.struct("bucket", "r", "t"))).alias("buckets"), F.sum("r").alias("r"), F.sum("t").alias("t"))
    return every.select(F.transform("buckets", lambda b: F.round(UNIT * (
        F.log(b["t"] / F.col("t")) - F.log(b["r"] / F.col("r")))).cast("int")).alias("ratios"))


def fit(raw, target, text="text", bits=BUCKET_BITS, smoothing=SMOOTHING):
    """The log ratios of all buckets, in order, as text: whole numbers joined by commas.

    Counts cover all rows of both frames. The driver gets this one text, whose length the
    number of buckets bounds.
    """
    rows = log_ratios(raw, target, text, bits, smoothing)
    return rows.select(F.array_join(F.col("ratios").cast("array<string>"), ",").alias("ratios")).first()["ratios"]


def judged(df, ratios, text="text", keep=("doc_id",), threshold=THRESHOLD):
    """The columns `keep` of `df` (small ones) and those of RESULT, one row for each of its rows.

    n_words; word_chars, their characters; n_symbols; n_dup_lines, lines with a word that
    equal an earlier line; n_repeat_words, words in windows of three that stand at least
    twice in the text. base_failed: under 50 words, or more than half of them repeated.
    score: the mean log ratio of the n-grams, in nats, 0 without words. kept: not
    base_failed and a score of at least `threshold`. NULL counts as an empty text: no
    words, base_failed, not kept. Repeated rows stay; of other columns nothing is read.
    """
    bits = ratios.count(",").bit_length()
    table = F.split(F.lit(ratios), ",").cast("array<int>")
    kept = [F.col(f"`{c}`").alias(f"__keep{k}") for k, c in enumerate(keep)]
    carried = [f"__keep{k}" for k in range(len(keep))] + ["__row"]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # Generators of one row each, as their columns are then computed once.
    first = df.select(*kept, F.monotonically_increasing_id().alias("__row"), F.inline(F.array(F.struct(
        words_of(F.col(f"`{text}`")).alias("words"),
        F.when(body.rlike("[#*$%&|<>]"), F.length(body) - F.length(without(body, SYMBOLS))).otherwise(F.lit(0)).cast("long").alias("n_symbols"),
        lines.alias("lines")))))
    words = F.col("words")
    # A window's place in the lower bits of its hash: sorted, equal windows are neighbours.
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size(words).cast("long")))) - 1
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    second = first.select(*carried, "words", "n_symbols", F.inline(F.array(F.struct(
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        mask.alias("mask"),
        F.slice(hashes, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))).alias("hashes")))))
    placed = F.sort_array(F.transform("hashes", lambda h, i: h.bitwiseAND(F.bitwise_not("mask")).bitwiseOR(i.cast("long"))))
    third = second.select(*carried, "words", "n_symbols", "word_chars", "n_dup_lines", F.inline(F.array(F.struct(
        F.col("mask").alias("mask"), placed.alias("placed")))))
    p, low = F.col("placed"), F.col("mask")

    def alike(a, b):
        return F.coalesce(F.shiftrightunsigned(a.bitwiseXOR(b), 1) <= F.shiftrightunsigned(low, 1), F.lit(False))

    near = F.transform(F.filter(p, lambda x, k: alike(x, F.get(p, k + 1)) | alike(x, F.get(p, k - 1))),
                       lambda x: x.bitwiseAND(low).cast("int"))
    windows = F.sort_array(F.transform(near, lambda i: F.struct(
        F.concat_ws(" ", *[F.get(words, i + k) for k in range(WINDOW)]).alias("w"), i.alias("i"))))
    fourth = third.select(*carried, "words", "n_symbols", "word_chars", "n_dup_lines", F.inline(F.array(F.struct(windows.alias("windows")))))
    s = F.col("windows")
    again = F.filter(s, lambda x, k: (F.get(s, k - 1)["w"] == x["w"]) | (F.get(s, k + 1)["w"] == x["w"]))
    fifth = fourth.select(*carried, "words", "n_symbols", "word_chars", "n_dup_lines", F.inline(F.array(F.struct(
        F.sort_array(F.transform(again, lambda x: x["i"])).alias("places")))))
    # Each repeated window adds the words that the next one doesn't hold as well.
    d = F.col("places")
    added = F.zip_with(d, F.slice(d, 2, F.greatest(F.size(d) - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measured = fifth.select(
        *carried, F.size(words).cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.aggregate(added, F.lit(0).cast("long"), lambda acc, x: acc + x).alias("n_repeat_words"), "words")
    # All n-grams of a text are in one task: one row per text is left to move.
    one, two = (F.coalesce(F.get(table, b), F.lit(0)) for b in buckets_of(F.col("g"), bits))
    summed = measured.select(*carried, *numbers, grams(words)).groupBy(*carried, *numbers).agg(F.sum((one + two).cast("long")).alias("total"))
    n_words = F.col("n_words")
    n_grams = F.greatest(2 * n_words - 1, F.lit(1))
    failed = (n_words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n_words)
    return summed.select(
        *[F.col(f"__keep{k}").alias(c) for k, c in enumerate(keep)], *numbers,
        (F.col("total") / n_grams / UNIT).alias("score"), failed.alias("base_failed"),
        (~failed & (F.col("total") >= round(threshold * UNIT) * n_grams)).alias("kept"))
