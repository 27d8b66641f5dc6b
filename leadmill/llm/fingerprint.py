"""Document fingerprints from closed syncmers of words.

A window of K words is an anchor when the smallest of its inner stretches of S words
lies at its start or its end. That depends on the window alone, so equal passages have
equal anchors wherever they stand, and anchors with their positions align two texts.
Two texts are compared by all their anchors: those that match fall into runs in which
both texts go on from anchor to anchor, and the heaviest chain of runs that stand in the
same order in both counts as common. A hash that repeats is matched first to first and so
on. The fingerprint, a column beside it, is the SKETCH smallest distinct anchor hashes
of the whole text.

Everything runs on SQL functions. Null text is empty and has no anchors; texts of
few words in which no window is an anchor have one, all their words. Two empty fingerprints are alike (1).
Rows keep their columns, repeated rows included; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadmill.llm.common import partitions, whole_text

K, S = 5, 2
SKETCH = 128
SPACE = r"[\x20\x09-\x0D]+"
HASHES = "array<bigint>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<position, hash>>: word positions from 0 and hashes of the anchors of a text."""
    inner = k - s + 1

    def of_words(words: Column) -> Column:
        n = F.size(words)

        def of_stretches(stretches: Column) -> Column:
            def chosen(i: Column) -> Column:
                inside = [F.get(stretches, i + j) for j in range(inner)]
                return F.array_min(F.array(*inside)).isin(inside[0], inside[-1])

            return F.filter(F.sequence(F.lit(0), n - k), chosen)

        stretch = F.transform(
            words, lambda w, i: F.xxhash64(*[F.get(words, i + j) for j in range(s)])
        )
        whole = F.when(n > 0, F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(words).alias("hash")))).otherwise(
            F.array().cast("array<struct<position:int,hash:bigint>>")
        )

        def named(places: Column) -> Column:
            found = F.transform(places, lambda i: F.struct(i.alias("position"), F.xxhash64(*[F.get(words, i + j) for j in range(k)]).alias("hash")))
            return F.when(F.size(places) > 0, found).otherwise(whole)

        return F.when(n >= k, let(let(stretch, of_stretches), named)).otherwise(whole)

    words = F.array_remove(F.split(text, SPACE, -1), "")
    return let(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def sketch(text: Column, k: int = K, s: int = S, size: int = SKETCH) -> Column:
    return sketch_of(anchors(text, k, s), size)


def sketch_of(found: Column, size: int = SKETCH) -> Column:
    hashes = F.transform(found, lambda a: a["hash"])
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def likeness(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Share of common anchors, estimated from two sketches."""
    def of(both: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(a, b), both))
        return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.size(both))

    return let(F.slice(F.sort_array(F.array_union(a, b)), 1, size), of)


def aligned(a: Column, b: Column) -> Column:
    """Share of anchors in common that stand in the same order, from all anchors of two texts."""

    def sided(found: Column, side: int) -> Column:
        return F.transform(found, lambda h, i: F.struct(h.alias("hash"), F.lit(side).alias("side"), i.alias("at")))

    def met(entries: Column) -> Column:
        def starts_at(e: Column, i: Column) -> Column:
            return F.when((i == 0) | (e["hash"] != F.get(entries, i - 1)["hash"]), i)

        def paired(same: Column) -> Column:
            """First to first, second to second, of the anchors with one hash: those of ``a``, then those of ``b``."""
            return let(F.size(F.filter(same, lambda e: e["side"] == 0)), lambda n: F.zip_with(
                F.slice(same, F.lit(1), F.least(n, F.size(same) - n)), F.slice(same, n + 1, F.least(n, F.size(same) - n)),
                lambda x, y: F.struct(x["at"].alias("a"), y["at"].alias("b")),
            ))

        def cut(starts: Column) -> Column:
            def group(s: Column, i: Column) -> Column:
                end = F.coalesce(F.get(starts, i + 1), F.size(entries))
                return F.when(
                    F.get(entries, s)["side"] != F.get(entries, end - 1)["side"], let(F.slice(entries, s + 1, end - s), paired)
                )

            return F.sort_array(F.flatten(F.array_compact(F.transform(starts, group))))

        return let(F.array_compact(F.transform(entries, starts_at)), cut)

    def runs(pairs: Column) -> Column:
        def starts_at(p: Column, i: Column) -> Column:
            last = F.get(pairs, i - 1)
            return F.when((i == 0) | (p["a"] != last["a"] + 1) | (p["b"] != last["b"] + 1), i)

        def cut(starts: Column) -> Column:
            return F.transform(starts, lambda s, i: F.struct(
                F.get(pairs, s)["b"].alias("b"), (F.coalesce(F.get(starts, i + 1), F.size(pairs)) - s).alias("n")
            ))

        return let(F.array_compact(F.transform(pairs, starts_at)), cut)

    def heaviest(found: Column) -> Column:
        def chain(state: Column, run: Column) -> Column:
            before = F.array_max(F.transform(state, lambda s: F.when(s["b"] < run["b"], s["best"]).otherwise(0)))
            return F.array_append(state, F.struct(run["b"].alias("b"), (run["n"] + F.coalesce(before, F.lit(0))).alias("best")))

        none = F.array().cast("array<struct<b:int,best:int>>")
        return F.coalesce(F.array_max(F.transform(F.aggregate(found, none, chain), lambda s: s["best"])), F.lit(0))

    def in_order(rest: Column) -> Column:
        """Anchors in common from all of ``rest``; without a hash in common nothing is sorted."""
        found = let(let(F.sort_array(F.concat(sided(rest["x"], 0), sided(rest["y"], 1))), met), lambda pairs: heaviest(runs(pairs)))
        return F.when(F.arrays_overlap(rest["x"], rest["y"]), found).otherwise(0)

    def of_hashes(both: Column) -> Column:
        x, y = both["x"], both["y"]
        n, m = F.size(x), F.size(y)

        def after(start: Column) -> Column:
            """Equal starts match anchor by anchor, repeats included, and stand before all else in both."""
            rest = F.struct(F.slice(x, start + 1, n - start).alias("x"), F.slice(y, start + 1, m - start).alias("y"))
            return let(start + let(rest, in_order), lambda c: c / (n + m - c))

        same = F.zip_with(x, y, lambda h, g: h.eqNullSafe(g))
        start = let(F.array_position(same, F.lit(False)), lambda at: F.when(at == 0, n).otherwise(at - 1).cast("int"))
        return F.when(n + m == 0, F.lit(1.0)).otherwise(let(start, after))

    hashes = [F.transform(found, lambda e: e["hash"]) for found in (a, b)]
    return let(F.struct(hashes[0].alias("x"), hashes[1].alias("y")), of_hashes)


def as_text(hashes: Column) -> Column:
    """Fixed-width hexadecimal, comma-joined."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), ",")


def ranges(docs: DataFrame, n: int) -> tuple[Column, list]:
    """Which of about ``n`` ranges of doc_id a row is in, and the largest id of each range.

    The bounds are quantiles found by one aggregation; a row finds its range by halving.
    """
    shares = [(i + 1) / n for i in range(n - 1)] or [0.5]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] or []
    bounds = sorted(set(cuts))
    if not bounds:
        return F.lit(0), []
    # constants that the optimiser folds into an array
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast(HASHES)
    steps = [1 << b for b in reversed(range(len(bounds).bit_length()))]

    def halve(low: Column, step: Column) -> Column:
        inside = (low + step <= len(bounds)) & (F.element_at(table, F.least(low + step, F.lit(len(bounds)))) < F.col("doc_id"))
        return F.when(inside, low + step).otherwise(low)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), halve), bounds


def beside_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with next_<column> of the next document in descending doc_id, the first one after the last.

    Ties of doc_id are ordered by text. Rows are dealt into ranges of doc_id once; the
    first document of a range is also sent to the range above, which it follows.
    """
    spark = docs.sparkSession
    place, _ = ranges(docs, 4 * partitions(spark))
    heads = docs.where("doc_id is not null").groupBy(place.alias("place")).agg(F.max("doc_id").alias("doc_id")).orderBy("place").collect()  # one row per range
    used = [h.place for h in heads]
    after = {h.doc_id: used[(i + 1) % len(used)] for i, h in enumerate(heads)}
    ghosts = spark.createDataFrame([(k, v) for k, v in after.items()], "doc_id bigint, above int")
    copies = F.array_compact(F.array(
        F.struct(place.alias("place"), F.lit(False).alias("ghost")),
        F.when(F.col("above").isNotNull(), F.struct(F.col("above").alias("place"), F.lit(True).alias("ghost"))),
    ))
    dealt = docs.join(F.broadcast(ghosts), "doc_id", "left").withColumn("__copy", F.explode(copies)).drop("above")
    order = Window.partitionBy("__copy.place").orderBy("__copy.ghost", F.col("doc_id").desc_nulls_last(), "text")
    return dealt.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns}).where("not __copy.ghost").drop("__copy")


def edited(docs: DataFrame) -> DataFrame:
    """(doc_id, text, edited, anchors, next_anchors, sketch): the last half of each text replaced by the start of the next document."""
    both = beside_next(docs.select("doc_id", whole_text().alias("text")), ["text"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    following = F.coalesce("next_text", "text")
    new = F.concat(F.substring("text", F.lit(1), n - half), F.substring(following, F.lit(1), half))
    found = both.withColumns({"edited": new, "anchors": anchors(F.col("text")), "next_anchors": anchors(following)})
    return found.withColumn("sketch", sketch_of(F.col("anchors"))).drop("next_text")
