"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text's fingerprints are the least hash of ``gram`` words in each run of ``window - gram + 1`` grams, so two texts that share
``window`` words in a row share a fingerprint. Fingerprints of documents and items are joined; where one meets, both sides are
extended word by word, at most to the window's length on either side, and compared as words, so that hashes decide nothing. Items
of fewer words than a window have no run to choose from; each is one gram of its own length and is looked for at every place.

Texts are matched by content: equal texts are extended once, and null or equal ids make no difference; an item without an id counts as
a hit and is in no list of items. Null and empty texts have no
words, no hits and no items; an empty benchmark leaves every document clean. Other columns are not read. Joins have no hint: the item
table is written first, so that Spark knows its size and sends it to all tasks only below its own limit.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import stored

WINDOW, GRAM = 10, 6
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Words after A-Z are lower-cased; all-ASCII texts take the quick way to the same result."""
    plain = F.octet_length(text) == F.length(text)
    lower = F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(F.coalesce(lower, F.lit("")), SEPARATORS), "")


def grams(w: Column, n: int) -> Column:
    """Hash of each n words in a row."""
    places = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(n)]))


def chosen(h: Column, window: int, gram: int) -> Column:
    """Distinct least hashes of each run of grams that makes up a window."""
    run = window - gram + 1
    places = F.when(F.size(h) >= run, F.sequence(F.lit(0), F.size(h) - run)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda j: F.least(*[F.get(h, j + t) for t in range(run)])))


def fingerprints(w: Column, window: int, gram: int, short: list[int]) -> Column:
    """The fingerprints of a text, and every gram of the lengths ``short``; the gram's length goes with each."""
    tag = lambda hashes, n: F.transform(hashes, lambda x: F.struct(F.lit(n).alias("n"), x.alias("h")))
    parts = [tag(bind(grams(w, gram), lambda h: chosen(h, window, gram)), window)]
    parts += [tag(F.array_distinct(grams(w, n)), n) for n in short]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def places(w: Column, wanted: Column, window: int, gram: int, lengths: list[int]) -> Column:
    """Each place of a wanted fingerprint: n, h, at, its words, and up to window - gram words to the left (nearest first) and right."""
    reach = window - gram

    def at(n: int) -> Column:
        size, side = (gram, reach) if n == window else (n, 0)
        hits = F.filter(F.transform(grams(w, size), lambda h, i: F.struct(i.alias("at"), F.struct(F.lit(n).alias("n"), h.alias("h")).alias("f"))),
                        lambda x: F.array_contains(wanted, x["f"]))
        return F.transform(hits, lambda x: F.struct(
            x["f"]["n"].alias("n"), x["f"]["h"].alias("h"), x["at"].alias("at"), F.slice(w, x["at"] + 1, size).alias("gram"),
            F.reverse(F.slice(w, F.greatest(x["at"] - side, F.lit(0)) + 1, F.least(x["at"], F.lit(side)))).alias("left"),
            F.slice(w, x["at"] + size + 1, side).alias("right")))

    return F.concat(*[at(n) for n in [window, *lengths]]) if lengths else at(window)


def agree(a: Column, b: Column, most: int) -> Column:
    """How many leading words are the same."""
    out = F.lit(most)
    for i in reversed(range(most)):
        out = F.when(F.coalesce(F.get(a, F.lit(i)) == F.get(b, F.lit(i)), F.lit(False)), out).otherwise(i)
    return out


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` columns with n_words, n_hit, item_ids (sorted strings) and contaminated."""
    reach = window - gram
    tests = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    sizes = tests.select(F.least(F.size("w"), F.lit(window)).alias("n")).distinct().collect()  # at most ``window`` numbers
    short = sorted(r["n"] for r in sizes if r["n"] < window)
    own = F.filter(fingerprints(F.col("w"), window, gram, short), lambda f: (f["n"] == window) | (f["n"] == F.size("w")))
    spots = bind(F.col("w"), lambda w: bind(own, lambda f: places(w, f, window, gram, short)))
    test_places = tests.select("item", F.explode(spots).alias("p")).select("item", "p.*")
    test_places = test_places.groupBy("n", "h", "gram", "left", "right").agg(F.collect_set("item").alias("items"))
    test_places = stored(test_places, "benchmark-places")
    wanted = stored(test_places.select("n", "h").distinct(), "benchmark-fingerprints")

    key = F.unhex(F.md5("text")).alias("_key")
    texts = docs.select(key, "text").where("text is not null")
    found = texts.select("_key", F.explode(bind(words(F.col("text")), lambda w: fingerprints(w, window, gram, short))).alias("f"))
    found = found.select("_key", "f.n", "f.h").join(wanted, ["n", "h"])
    found = found.groupBy("_key").agg(F.collect_set(F.struct("n", "h")).alias("_f"))
    found = stored(found, "met")
    met = texts.join(found, "_key").dropDuplicates(["_key"])
    spot = bind(words(F.col("text")), lambda w: places(w, F.col("_f"), window, gram, short))
    met = met.select("_key", F.explode(spot).alias("p")).select("_key", "p.*").withColumnsRenamed({"left": "l", "right": "r"})
    met = met.join(test_places, ["n", "h", "gram"])
    left, right = agree(F.col("l"), F.col("left"), reach), agree(F.col("r"), F.col("right"), reach)
    met = met.select("_key", "items", "at", "n", left.alias("a"), right.alias("b")).where(f"n < {window} or a + b >= {reach}")
    from_ = F.when(F.col("n") < window, F.col("at")).otherwise(F.col("at") - F.col("a"))
    to = F.when(F.col("n") < window, F.col("at") + F.col("n")).otherwise(F.col("at") + gram + F.col("b"))
    spans = met.groupBy("_key").agg(
        F.collect_set(F.struct(from_.alias("a"), to.alias("b"))).alias("s"), F.flatten(F.collect_set("items")).alias("items"))
    spans = spans.select("_key", F.size(F.array_distinct(F.flatten(F.transform("s", lambda s: F.sequence(s["a"], s["b"] - 1))))).alias("_hit"),
                         F.array_sort(F.array_distinct("items")).alias("_items"))
    spans = stored(spans, "hits")
    out = docs.withColumn("_key", key).join(spans, "_key", "left")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.size(words(F.col("text"))).cast("long").alias("n_words"),
                      F.coalesce("_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("_items", F.array().cast("array<string>")).alias("item_ids"), F.col("_hit").isNotNull().alias("contaminated"))
