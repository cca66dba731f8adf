"""Pairs of names of one group whose token set ratio reaches a threshold, without comparing all pairs of a large group.

The ratio is the best of three, and each of the first two cases below leaves few partners for a name:

* one side's words are nearly all shared (by length), as when it is contained in the other: at least one of its rarest
  words, which together are longer than what may be missing, is a word of the other;
* the words that are not shared are nearly alike letter by letter, in any of them: then most of the sides' pairs of
  neighbouring characters agree. Of two sides that agree in all but so many, the two rarest common pairs stand among
  the rarest that each side has, so it is enough to meet under two of these at once.

Both are followed by bounds over the whole name, as array expressions; only what passes them is measured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import token_set
from .graph import reliable

#: Added to what may differ, against rounding.
SLACK = 1e-9
#: Forms of a group that is compared pair by pair: half as many pairs for each form, where postings are 100 and more.
PAIRED = 64


def name_form(name: Column | str) -> Column:
    """A name's distinct words in order, joined by spaces: all that the token set ratio knows of it."""
    value = F.col(name) if isinstance(name, str) else name
    words = F.split(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)[\s\x1c-\x1f]+", " "), " ")
    return F.array_join(F.array_sort(F.array_distinct(F.filter(words, lambda w: w != ""))), " ")


def _floor(x: Column) -> Column:
    return F.floor(x + SLACK).cast("int")


def _rarest_words(forms: DataFrame, least: float) -> DataFrame:
    """(form, word): a form's rarest words, so many that without them too little would be shared."""
    words = forms.select("form", F.explode(F.split("form", " ")).alias("word"))
    ranked = words.join(words.groupBy("word").agg(F.count("*").alias("n")), "word")
    ranked = ranked.groupBy("form").agg(F.sort_array(F.collect_list(F.struct("n", "word"))).alias("words"))
    may_lack = F.greatest(F.lit(0), _floor((least * (2 * F.length("form") - 1) - 1) / (1 + least)))
    none = F.struct(F.lit(0).alias("size"), F.array().cast("array<string>").alias("taken"))
    more = lambda s, w: F.struct((s["size"] + F.length(w["word"]) + 1).cast("int").alias("size"), F.array_append(s["taken"], w["word"]).alias("taken"))
    taken = F.aggregate("words", none, lambda s, w: F.when(s["size"] - 1 > may_lack, s).otherwise(more(s, w)))
    return ranked.select("form", F.explode(taken["taken"]).alias("word"))


def _nearly_contained(forms: DataFrame, of: DataFrame, least: float) -> DataFrame:
    """(g, x, y): forms x whose words y shares but for a small part."""
    rare = of.join(_rarest_words(forms, least), "form").select("g", "word", F.col("form").alias("x"))
    every = of.select("g", F.explode(F.split("form", " ")).alias("word"), F.col("form").alias("y"))
    pairs = rare.join(every, ["g", "word"]).filter("x <> y").select("g", "x", "y")
    own = F.length(F.array_join(F.array_except(F.split("x", " "), F.split("y", " ")), " "))
    shared = F.length(F.array_join(F.array_intersect(F.split("x", " "), F.split("y", " ")), " "))
    return pairs.filter((own == 0) | (1 + own <= least * (2 * shared + 1 + own) + SLACK))


def _bigrams(forms: DataFrame) -> DataFrame:
    """(form, n, grams): pairs of neighbouring characters, ends included, the rarest first; repeats are numbered."""
    padded = F.concat(F.lit(" "), "form", F.lit(" "))
    at = F.posexplode(F.transform(F.sequence(F.lit(1), F.length("form") + 1), lambda i: F.substring(padded, i, F.lit(2)))).alias("at", "gram")
    grams = forms.select("form", at).groupBy("form", "gram").agg(F.count("*").alias("k"))
    grams = grams.select("form", F.explode(F.transform(F.sequence(F.lit(1), F.col("k").cast("int")), lambda i: F.concat("gram", i.cast("string")))).alias("gram"))
    ranked = grams.join(grams.groupBy("gram").agg(F.count("*").alias("n")), "gram")
    ranked = ranked.groupBy("form").agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("grams"))
    return ranked.select("form", F.length("form").alias("n"), F.col("grams.gram").alias("grams"))


def _nearly_alike(forms: DataFrame, of: DataFrame, least: float) -> DataFrame:
    """(g, x, y): forms, x not the longer one, that agree in so many bigrams that the rest may be alike enough."""
    grams = reliable(_bigrams(forms))

    def posted(out: str, lost: Column) -> DataFrame:
        first = F.slice("grams", F.lit(1), lost + 2)
        pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.size(first) - 1), lambda i: F.transform(F.slice(first, i + 1, F.size(first)), lambda b: F.xxhash64(F.element_at(first, i), b))))
        return of.join(grams.select("form", "n", F.explode(F.array_distinct(pairs)).alias("two")), "form").select("g", "two", F.col("form").alias(out), F.col("n").alias(f"n_{out}"))

    shorter, longer = posted("x", _floor(3 * least * F.col("n"))), posted("y", _floor(4 * least / (1 + least) * F.col("n")))
    sizes = ((F.col("n_x") < F.col("n_y")) | (F.col("n_x") == F.col("n_y")) & (F.col("x") < F.col("y"))) & (F.col("n_y") * (1 - least) <= F.col("n_x") * (1 + least) + SLACK)
    pairs = shorter.join(longer, ["g", "two"]).filter(sizes).select("g", "x", "y").distinct()
    side = lambda c: grams.select(F.col("form").alias(c), F.col("grams").alias(f"g_{c}"))
    pairs = pairs.join(side("x"), "x").join(side("y"), "y")
    x, y = F.length("x"), F.length("y")
    edits = _floor(least * (x + y))
    lost = edits + F.floor((edits - (y - x)) / 2)
    return pairs.filter((edits >= y - x) & (F.size(F.array_intersect("g_x", "g_y")) >= x + 1 - lost)).select("g", "x", "y")


def _posted(of: DataFrame, least: float) -> DataFrame:
    """(g, a, b), a < b: the pairs of a group that one of the two cases leaves."""
    forms = of.select("form").distinct()
    found = _nearly_contained(forms, of, least).union(_nearly_alike(forms, of, least))
    return found.select("g", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _paired(of: DataFrame) -> DataFrame:
    """(g, a, b), a < b: all pairs of a group."""
    groups = of.groupBy("g").agg(F.sort_array(F.collect_list("form")).alias("forms"))
    first = groups.select("g", "forms", F.posexplode("forms").alias("at", "a"))
    return first.select("g", "a", F.explode(F.slice("forms", F.col("at") + 2, F.size("forms"))).alias("b"))


def similar_forms(rows: DataFrame, threshold: float) -> DataFrame:
    """(g, a, b, similarity), a < b, of all pairs of forms of one group with a token set ratio of `threshold` (75 at least) or
    more. rows: (g, form), see name_form; empty forms are like none, and repeated rows count once.

    A group of up to PAIRED forms has fewer pairs than postings, so it goes without these. What is left is measured once
    for two forms, in however many groups they meet.
    """
    if threshold < 75:
        raise ValueError("the bounds hold for thresholds of 75 and more")
    least = 1 - threshold / 100
    of = reliable(rows.filter("g is not null and form <> ''").select("g", "form").distinct())
    large = reliable(of.groupBy("g").agg(F.count("*").alias("n")).filter(F.col("n") > PAIRED).select("g"))
    found = _paired(of.join(large, "g", "left_anti"))
    if not large.isEmpty():
        found = found.union(reliable(_posted(of.join(large, "g", "left_semi"), least)))
    two = reliable(found.select("a", "b").distinct())  # a table, or Spark would measure before it drops repeats
    measured = reliable(two.withColumn("similarity", token_set("a", "b")).filter(F.col("similarity") >= threshold))
    return found.join(measured, ["a", "b"]).select("g", "a", "b", "similarity")
