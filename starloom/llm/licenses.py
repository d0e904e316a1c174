"""License scan by ordered signature rules, in DataFrame functions only.

A text is lower-cased (A-Z) and cut into words. Texts that hold no gate words skip all
patterns; of the rest, each rule is matched at all places if one of its keywords is a
word of the text. Gates and keywords follow from the patterns: no match is without. A match inside another one of the same or a higher priority is suppressed. The
scan is one projection: rows never move.
"""

import json
import string

from pyspark.sql import functions as F

from starloom.llm.license_rules import all_rules, gates, keywords

# Fixed values of the base detection: phrase and label.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same words before lower-casing; as a positive class it runs several times faster.
WORD = r"[0-9A-Za-z\x80-\x{10FFFF}]++"

TABLE = "array<struct<label:string,keywords:array<string>,priority:int,confidence:double,pattern:string>>"


def normal_words(text):
    """`text` with A-Z lower-cased, its words joined by single spaces."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.trim(F.regexp_replace(lowered, NOT_WORD, " "))


def phrase_places(words, n_words, phrase):
    """(places, first, last): how often, and at which words, `phrase` stands in `words`.

    Each word carries its own space on both sides, so neighbouring places share no
    character and splitting at the phrase finds all of them.
    """
    spaced = F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))
    pieces = F.split(spaced, " " + phrase.replace(" ", "  ") + " ", -1)

    def count(piece):
        return ((F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))) / 2).cast("long")

    places = (F.size(pieces) - 1).cast("long")
    first = F.when(places > 0, count(F.element_at(pieces, 1)))
    last = F.when(places > 0, n_words - count(F.element_at(pieces, -1)) - len(phrase.split()))
    return places, first, last


def _spans(padded, rule):
    """All matches of one rule as (start, end, …), counted in characters."""
    pattern = F.concat(F.lit("(?<= )(?:"), rule["pattern"], F.lit(")(?= )"))
    found = F.regexp_extract_all(padded, pattern, F.lit(0))
    between = F.split(padded, pattern, -1)
    steps = F.zip_with(between, found, lambda gap, hit: F.struct(
        F.length(gap).alias("gap"), F.length(hit).alias("len")))
    none = F.array().cast("array<struct<start:int,end:int,priority:int,confidence:double,label:string>>")
    walked = F.aggregate(
        F.filter(steps, lambda s: s["len"].isNotNull()),
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["len"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + s["gap"]).alias("start"),
                (acc["at"] + s["gap"] + s["len"]).alias("end"),
                rule["priority"].alias("priority"),
                rule["confidence"].alias("confidence"),
                rule["label"].alias("label"),
            ))).alias("spans"),
        ),
    )
    return walked["spans"]


def detections(words, rules=None):
    """A struct of the labels and the best confidence of matches that no other suppresses.

    Sorted by start, longer first, then priority, whatever contains a match comes ahead
    of it; so one pass that keeps the furthest end of each priority tells which matches
    are contained. NULL gives no labels and confidence 0.
    """
    rules = all_rules() if rules is None else rules
    table = F.from_json(F.lit(json.dumps([r._asdict() | {"keywords": keywords(r)} for r in rules])), TABLE)
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    tried = F.filter(table, lambda r: (F.size(r["keywords"]) == 0) | F.exists(
        r["keywords"], lambda k: F.contains(padded, F.concat(F.lit(" "), k, F.lit(" ")))))
    spans = F.flatten(F.transform(tried, lambda r: _spans(padded, r)))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"), (-s["priority"]).alias("down"),
        s["label"].alias("label"), s["confidence"].alias("confidence"))))
    levels = max(r.priority for r in rules) + 1

    def step(acc, s):
        end, priority = -s["back"], -s["down"]
        free = F.element_at(acc["furthest"], priority + 1) < end
        return F.struct(
            F.transform(acc["furthest"], lambda e, i: F.when(i <= priority, F.greatest(e, end)).otherwise(e)).alias("furthest"),
            F.when(free, F.array_union(acc["labels"], F.array(s["label"]))).otherwise(acc["labels"]).alias("labels"),
            F.when(free, F.greatest(acc["confidence"], s["confidence"])).otherwise(acc["confidence"]).alias("confidence"),
        )

    return F.aggregate(ordered, F.struct(
        F.array_repeat(F.lit(0), levels).alias("furthest"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("confidence")), step)


def scan(df, text="text", rules=None):
    """`df` with the columns n_words, n_base, first_word, last_word, base_labels, labels, score.

    A NULL text counts as empty: 0 words, no places, empty labels, score 0. Rows stay
    as they are, repeated ones included; columns of these names are replaced.
    """
    kept = [c for c in df.columns if c not in RESULT]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lowered = F.lower(body)
    gate = F.lit(False)
    for group in gates(tuple(all_rules() if rules is None else rules), tuple(phrase for phrase, _ in BASE)):
        held = F.lit(True)
        for word in group:
            held = held & F.contains(lowered, F.lit(word))
        gate = gate | held
    frame = df.select(*[F.col(f"`{c}`") for c in kept], F.when(gate, normal_words(body)).alias("__words"),
                      F.regexp_count(body, F.lit(WORD)).cast("long").alias("__n"))
    words, n = F.col("__words"), F.col("__n")
    places = [phrase_places(words, n, phrase) for phrase, _ in BASE]
    n_base = sum((F.coalesce(p, F.lit(0)) for p, _, _ in places), F.lit(0)).cast("long")
    own = F.array_compact(F.array(*[F.when(p > 0, F.lit(label)) for (p, _, _), (_, label) in zip(places, BASE)]))
    # A generator of one row each, as its columns are then computed once.
    found = frame.select(
        *[F.col(f"`{c}`") for c in kept],
        n.alias("n_words"),
        F.inline(F.array(F.struct(
            F.when(words.isNotNull(), F.struct(
                n_base.alias("n_base"),
                F.least(*[f for _, f, _ in places]).alias("first_word"),
                F.greatest(*[last for _, _, last in places]).alias("last_word"),
                own.alias("own"))).alias("__base"),
            F.when(words.isNotNull(), detections(words, rules)).alias("__more"),
        ))),
    )
    base, more = F.col("__base"), F.col("__more")
    joined = F.array_join(F.array_sort(base["own"]), ",")
    every = F.array_join(F.array_sort(F.array_union(base["own"], more["labels"])), ",")
    return found.select(
        *[F.col(f"`{c}`") for c in kept],
        "n_words",
        F.coalesce(base["n_base"], F.lit(0).cast("long")).alias("n_base"),
        base["first_word"].alias("first_word"),
        base["last_word"].alias("last_word"),
        F.coalesce(joined, F.lit("")).alias("base_labels"),
        F.coalesce(every, F.lit("")).alias("labels"),
        F.coalesce(F.greatest(more["confidence"], F.when(base["n_base"] > 0, 0.9)), F.lit(0.0)).alias("score"),
    )


RESULT = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
