"""Quality rules by divergence of distributions.

A document's histogram of character classes and its histogram of common words are compared
with those of every language by the Jensen-Shannon distance (base 2: 0 for equal, 1 for
disjoint distributions); the nearest language counts. A document that is too short to fill a
histogram is not judged by it. The references are sums over all documents of a language, and
so are its common words, the most frequent short ones; they are few and become literals of
the plan. Everything about one document is computed within its row by built-in functions, in
one pass over the texts once the common words are known; verdicts come from what it leaves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import GAP, stage

#: Character classes; what is in none of them is one more. Lower-case letters, most of a text,
#: are taken out first, so that the others are counted in what is left.
LOWER = r"\p{Ll}"
CLASSES = {
    "upper": r"\p{Lu}",
    "digit": r"[0-9]",
    "stop": r"[.,;:!?'\"()-]",
    "symbol": r"[#*$%&|<>]",
    "space": r"[\x20\x09-\x0D]",
}
#: Words in a window whose repetition counts.
WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """``common_words`` per language, of at most ``common_letters`` characters, fill its word
    histogram, all other words one more bin. A document is rejected above a distance, unless
    it has fewer characters or words than the guard of that histogram. The distance of words
    counts in parts of that of a document without any common word of the language, which
    follows from their share of the language's words: ``word_part`` holds whatever that is."""

    common_words: int = 24
    common_letters: int = 5
    class_distance: float = 0.28
    word_part: float = 0.94
    guard_chars: int = 300
    guard_words: int = 60


def _with_classes(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``c_all``, the characters of ``text``, and ``c_*``, those of each class."""
    count = lambda column: F.length(column).cast("long")
    df = df.withColumn("__rest", F.regexp_replace(text, f"{LOWER}+", ""))
    named = {f"c_{c}": count("__rest") - count(F.regexp_replace("__rest", f"{p}+", "")) for c, p in CLASSES.items()}
    df = df.withColumns({"c_all": count(text), "c_lower": count(text) - count("__rest"), **named})
    other = F.col("c_all") - sum((F.col(c) for c in _COUNTS[:-1]), F.lit(0))
    return df.withColumn("c_other", other).drop("__rest")


_COUNTS = ["c_lower", *(f"c_{c}" for c in CLASSES), "c_other"]


def common_words(docs: DataFrame, rules: Rules = Rules()) -> dict[str, dict[str, int]]:
    """For each language of all ``docs (text, lang)`` its common words with their counts."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"),
        F.explode(F.split(F.lower(F.col("text").cast("string")), GAP, -1)).alias("word"),
    )
    counts = rows.where(F.length("word").between(1, rules.common_letters)).groupBy("lang", "word").count()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= rules.common_words)
    found: dict[str, dict[str, int]] = {}
    for r in top.orderBy("lang", "word").collect():  # common_words rows for each language
        found.setdefault(r["lang"], {})[r["word"]] = r["count"]
    return found


def measured(docs: DataFrame, common: list[str]) -> DataFrame:
    """``docs`` with the base columns, the counts of ``_with_classes``, and ``hits``, how often
    each of the common words occurs."""
    text, words, windows = "__text", "__words", "__windows"
    in_lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    window = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, WINDOW))),
    )
    df = _with_classes(docs.withColumn(text, F.coalesce(F.col("text").cast("string"), F.lit(""))), text)
    df = df.withColumns({words: F.filter(F.split(text, GAP, -1), lambda w: w != ""), "__lines": in_lines})
    # common words by their place in the list
    listed = F.array(*(F.lit(c) for c in common)).cast("array<string>")
    hits = F.filter(words, lambda w: F.lower(w).isin(common)) if common else F.slice(words, 1, 0)
    places = F.transform(hits, lambda w: F.array_position(listed, F.lower(w)).cast("int"))
    df = df.withColumns({windows: window, "__common": places})
    # equal windows side by side; most documents repeat none and need no sorting
    by_hash = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    df = df.withColumn("__sorted", F.when(repeats, by_hash))
    twice = F.filter(
        "__sorted",
        lambda x, j: F.coalesce(x["h"] == F.get("__sorted", j - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get("__sorted", j + 1)["h"], F.lit(False)),
    )
    df = df.withColumn("__at", F.array_sort(F.transform(twice, lambda x: x["i"])))
    # each repeated window adds the words that the next one does not cover
    added = F.transform("__at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("__at", j + 1), p + WINDOW) - p))
    df = df.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.col("c_all") - F.col("c_space"),
            "n_symbols": F.col("c_symbol"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": F.coalesce(F.aggregate(added, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long"),
            "hits": F.array(
                *(F.size("__common") - F.size(F.array_remove("__common", n + 1)) for n in range(len(common)))
            ).cast("array<int>"),
        }
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    return df.drop(text, words, windows, "__lines", "__common", "__sorted", "__at")


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two distributions given as arrays of one length."""

    def half(x: Column, y: Column) -> Column:
        return F.when(x > 0, x / 2 * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: half(x, y) + half(y, x))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, b: a + b), F.lit(0.0)))


def _shares(counts: list[int]) -> Column:
    total = sum(counts)
    return F.array(*(F.lit(n / total if total else 0.0) for n in counts))


def judged(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs (text, lang, ...)`` without ``text``, with the base columns ``n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed``, with ``class_distance`` and
    ``word_distance`` (in parts of that of a document without common words) to the nearest
    language, and with ``kept``.

    A NULL or empty text has no words and fails. Rows without language or text make up no
    reference and are judged like others; without any reference distances are NULL and the
    base rules decide alone. Repeated rows stay and count as often in the references; an empty
    table gives no rows. Columns of ``docs`` with names of the new ones are replaced.
    """
    common = common_words(docs, rules)
    listed = sorted({w for words in common.values() for w in words})
    absent = F.col("text").isNull().alias("__absent")
    rows = stage(measured(docs.withColumn("__absent", absent), listed).drop("text"), "quality")
    labelled = rows.where("lang IS NOT NULL AND NOT __absent").groupBy(F.col("lang").cast("string").alias("lang"))
    references = labelled.agg(F.sum("n_words").alias("n_words"), *(F.sum(c).alias(c) for c in _COUNTS)).orderBy("lang")
    chars = F.greatest("c_all", F.lit(1))
    own_classes = F.transform(F.array(*_COUNTS), lambda n: n / chars)
    class_distances, word_distances = [], []
    for r in references.collect():  # one row for each language
        class_distances.append(_distance(own_classes, _shares([r[c] for c in _COUNTS])))
        known = common.get(r["lang"], {})
        hits = F.array(*(F.get("hits", F.lit(listed.index(w))).cast("long") for w in known)).cast("array<bigint>")
        others = F.col("n_words") - F.aggregate(hits, F.lit(0).cast("long"), lambda a, b: a + b)
        own_words = F.transform(F.concat(hits, F.array(others)), lambda n: n / F.greatest(F.col("n_words"), F.lit(1)))
        reference = _shares([*known.values(), r["n_words"] - sum(known.values())])
        without = F.array(*(F.lit(0.0) for _ in known), F.lit(1.0))
        # a language without common words has nothing to compare
        farthest = _distance(without, reference)
        word_distances.append(F.when(farthest > 0, _distance(own_words, reference) / farthest).otherwise(0.0))
    nearest = lambda each: F.round(F.array_min(F.array(*each)), 9) if each else F.lit(None).cast("double")
    rows = rows.withColumns({"class_distance": nearest(class_distances), "word_distance": nearest(word_distances)})
    odd = ((F.col("c_all") >= rules.guard_chars) & (F.col("class_distance") > rules.class_distance)) | (
        (F.col("n_words") >= rules.guard_words) & (F.col("word_distance") > rules.word_part)
    )
    rows = rows.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(odd, F.lit(False)))
    return rows.drop("hits", "c_all", "__absent", *_COUNTS)


def passed(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs (text, lang, ...)`` that are kept, with all their columns."""
    return judged(docs.select(F.struct("*").alias("__row"), "text", "lang"), rules).where("kept").select("__row.*")
