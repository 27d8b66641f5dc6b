"""String similarity: native bigram cosine, Arrow-batched edit measures, and tokens.

The array work is written as SQL text: one expression per column instead of
hundreds of calls from Python to the JVM to assemble it.

The ``*_tokens`` functions give short token lists with one promise: two texts
that reach the threshold share at least one token. They let a hot block be
matched by equi joins on tokens instead of pairing all its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leadmill import fixed_values as fixed
from leadmill.functions.text import without_accents
from leadmill.functions.values import flag, quoted

RARITY_BUCKETS = 1024
SLACK = 1e-9


def named(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def let(name: str, value: str, body: str) -> str:
    """SQL that computes ``value`` once and uses it by ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


# --- cosine of character bigrams

def plain_text(text: Column) -> Column:
    """Lower case without accents.

    Accents need Python for text beyond ASCII, which Spark keeps out of lambdas, so
    this is a column of its own before ``gram_vector``.
    """
    return without_accents(F.lower(text))


# every place where two characters follow each other, not both of them blank; the second
# half of a surrogate pair starts nothing
OVERLAPPING = r"(?s)(?![\x{DC00}-\x{DFFF}])(?=(.[^ ]|[^ ].))"

OVERLAPPING_ANY = r"(?s)(?![\x{DC00}-\x{DFFF}])(?=(..))"


def gram_vector(plain: str) -> str:
    """SQL of a struct with bigram counts and their norm, of a plain text; once per record.

    The bigrams are those of the words, each padded with blanks: two blanks between
    words give each word its own, and a bigram of two blanks belongs to none.
    """
    words = f"regexp_replace(trim(regexp_replace({plain}, r'(?U)\\s+', ' ')), ' ', '  ')"
    grams = f"case when {plain} <> '' then regexp_extract_all(concat(' ', {words}, ' '), r'{OVERLAPPING}', 1) else array() end"
    counts = "map_from_arrays(array_distinct(gs), transform(array_distinct(gs), g -> size(gs) - size(array_remove(gs, g))))"
    norm = "sqrt(cast(aggregate(map_values(m), 0, (t, n) -> t + n * n) as double))"
    return let("gs", grams, let("m", counts, f"named_struct('grams', m, 'norm', {norm})"))


def vector_cosine(left: str, right: str) -> str:
    """SQL of the cosine of two gram vectors; null when one is empty."""
    dot = (
        f"aggregate(map_entries({left}.grams), 0, "
        f"(t, e) -> t + e.value * coalesce(try_element_at({right}.grams, e.key), 0))"
    )
    return f"try_divide(cast({dot} as double), {left}.norm * {right}.norm)"


def with_cosine(df: DataFrame, left: str, right: str, into: str) -> DataFrame:
    """Cosine of two text columns of a table."""
    plain = df.withColumns({"__l": plain_text(quoted(left)), "__r": plain_text(quoted(right))})
    vectors = plain.withColumns({c: F.expr(gram_vector(c)) for c in ("__l", "__r")})
    return vectors.withColumn(into, F.expr(vector_cosine("__l", "__r"))).drop("__l", "__r")


# --- edit measures



def _scored(left: Column, right: Column, batch, worth: Column) -> Column:
    """Equal texts score 1 and hopeless ones 0 in the JVM; only the rest goes to Python."""
    filled = (left != "") & (right != "")
    open_ = filled & (left != right) & worth
    return (
        F.when(filled & (left == right), F.lit(1.0))
        .when(open_, batch(F.when(open_, left), F.when(open_, right)))
        .when(left.isNotNull() & right.isNotNull(), F.lit(0.0))
    )


def code_points(text: Column) -> Column:
    """The characters of a text as an array, a pair of surrogates as one."""
    return F.regexp_extract_all(text, F.lit(r"(?s)(.)"), F.lit(1))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used there."""
    return F.transform(F.array(value), body)[0]


def jaro_winkler_scores(left: Column, right: Column) -> Column:
    """Jaro-Winkler of two non-empty texts in the JVM, as ``batches.jaro_winkler_score`` computes it.

    One fold over the characters of ``left`` takes, for each, the first free equal
    character of ``right`` inside the match window; transpositions pair the matched
    characters of both sides in order; up to four equal first characters raise a
    Jaro score above 0.7. Work is len(left) * len(right) array steps at most.
    """

    def scored(both: Column) -> Column:
        a, b = both["a"], both["b"]
        la, lb = F.size(a), F.size(b)
        reach = F.greatest(F.floor(F.greatest(la, lb) / F.lit(2)).cast("int") - 1, F.lit(0))
        start = F.struct(F.array_repeat(F.lit(False), lb).alias("taken"), F.array().cast("array<string>").alias("common"))

        def step(state: Column, i: Column) -> Column:
            low, high = F.greatest(F.lit(0), i - reach), F.least(lb, i + reach + 1) - 1
            window = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
            free = F.get(F.filter(window, lambda k: ~state["taken"][k] & (b[k] == a[i])), F.lit(0))
            return bound(free, lambda first: F.when(first.isNull(), state).otherwise(F.struct(
                F.transform(state["taken"], lambda t, k: t | (k == first)).alias("taken"),
                F.concat(state["common"], F.array(a[i])).alias("common"),
            )))

        def finish(state: Column) -> Column:
            m = F.size(state["common"])
            other = F.filter(F.transform(b, lambda x, k: F.when(state["taken"][k], x)), lambda x: x.isNotNull())
            swapped = F.floor(F.size(F.filter(F.zip_with(state["common"], other, lambda x, y: x != y), lambda z: z)) / F.lit(2))
            first = F.least(F.lit(4), la, lb)
            miss = F.array_position(F.transform(F.sequence(F.lit(0), first - 1), lambda k: a[k] == b[k]), False)
            same = bound(miss, lambda place: F.when(place == 0, first).otherwise(place - 1))
            raised = bound(
                (m / la + m / lb + (m - swapped) / m) / F.lit(3.0),
                lambda jaro: F.when(jaro <= F.lit(0.7), jaro).otherwise(jaro + same * F.lit(0.1) * (F.lit(1.0) - jaro)),
            )
            return F.when(m == 0, F.lit(0.0)).otherwise(raised)

        return F.aggregate(F.sequence(F.lit(0), la - 1), start, step, finish)

    both = F.array(F.struct(code_points(left).alias("a"), code_points(right).alias("b")))
    return F.transform(both, scored)[0]


def jaro_winkler(left: Column, right: Column) -> Column:
    return _scored(left, right, jaro_winkler_scores, F.lit(True))


def damerau_levenshtein_distances(left: Column, right: Column) -> Column:
    """Edits with transpositions between two texts, in the JVM, as ``batches.damerau_levenshtein_distance``.

    The edit table is built row by row in a fold over the characters of ``left``; a
    row is a fold over those of ``right``. Row -1 and column -1 hold the sentinel
    len(left) + len(right); for each character of ``right`` the last row that had it is
    kept, and for the row the last column of a match, so a transposition may have edits
    in between. Without both there is none. Arrays hold column j at j + 1 and row i at i + 1.
    """

    def distance(both: Column) -> Column:
        a, b = both["a"], both["b"]
        la, lb = F.size(a), F.size(b)
        far = la + lb
        first_rows = F.array(
            F.array_repeat(far, lb + 2),
            F.concat(F.array(far), F.sequence(F.lit(0), lb)),
        )
        start = F.struct(first_rows.alias("table"), F.array_repeat(F.lit(0), lb).alias("last"))

        def row_of(state: Column, i: Column) -> Column:
            def row(line: Column) -> Column:
                table, up, x, last = line["t"], line["u"], line["x"], line["s"]

                def cell(built: Column, j: Column) -> Column:
                    r, col = built["r"], built["lc"]
                    plain = F.least(r[j] + 1, up[j + 1] + 1, up[j] + F.when(b[j - 1] == x, 0).otherwise(1))
                    moved = bound(last[j - 1], lambda seen: F.when(seen > 0, table[seen][col] + (i - seen) + (j - col) - 1))
                    return F.struct(
                        F.concat(r, F.array(F.when(col > 0, F.least(plain, moved)).otherwise(plain))).alias("r"),
                        F.when(b[j - 1] == x, j).otherwise(col).alias("lc"),
                    )

                opened = F.struct(F.array(far, i).alias("r"), F.lit(0).alias("lc"))
                built = F.aggregate(F.sequence(F.lit(1), lb), opened, cell, lambda done: done["r"])
                return F.struct(
                    F.concat(table, F.array(built)).alias("table"),
                    F.zip_with(last, b, lambda seen, y: F.when(y == x, i).otherwise(seen)).alias("last"),
                )

            line = F.struct(state["table"].alias("t"), state["table"][i].alias("u"), a[i - 1].alias("x"), state["last"].alias("s"))
            return bound(line, row)

        return F.aggregate(F.sequence(F.lit(1), la), start, row_of, lambda done: done["table"][la + 1][lb + 1])

    both = F.array(F.struct(code_points(left).alias("a"), code_points(right).alias("b")))
    return F.transform(both, distance)[0]


def damerau_levenshtein_scores(left: Column, right: Column) -> Column:
    """1 - distance / longer length of two non-empty texts, in the JVM."""
    longer = F.greatest(F.size(code_points(left)), F.size(code_points(right)))
    return F.lit(1.0) - damerau_levenshtein_distances(left, right) / longer


def damerau_levenshtein(left: Column, right: Column) -> Column:
    """1 - distance / longer length."""
    return _scored(left, right, damerau_levenshtein_scores, F.lit(True))


# --- 0/1 features

def exact_feature(left: Column, right: Column) -> Column:
    return flag(left == right)


def threshold_feature(score: Column, threshold: float = fixed.MATCH_THRESHOLD) -> Column:
    return flag(score >= F.lit(threshold))


def _kept(text: str, other: str) -> str:
    """SQL of the number of characters of a text that occur in the other at all."""
    return f"(length({text}) - length(translate({text}, {other}, '')))"


def jaro_winkler_feature(left: str, right: str, threshold: float = fixed.MATCH_THRESHOLD) -> Column:
    """1 where Jaro-Winkler of two columns reaches the threshold.

    Lengths and the common start bound the score from above, and so does the number of
    characters of each text that the other has at all, which its matches cannot exceed;
    only pairs that can still reach the threshold are scored, all in the JVM.
    """
    a, b = named(left), named(right)
    start = " + ".join(f"cast(substr({a}, 1, {n}) = substr({b}, 1, {n}) as int)" for n in range(1, 5))

    def can(most: str) -> str:
        jaro = f"({most} / nullif(length({a}), 0) + {most} / nullif(length({b}), 0) + 1) / 3"
        return f"({jaro} + ({start}) * 0.1D * (1 - {jaro}) >= {threshold - SLACK!r}D)"

    hopeful = F.expr(can(f"least(length({a}), length({b}))") + " and " + can(f"least({_kept(a, b)}, {_kept(b, a)})"))
    return threshold_feature(_scored(quoted(left), quoted(right), jaro_winkler_scores, hopeful), threshold)


def damerau_levenshtein_feature(left: str, right: str, threshold: float = fixed.MATCH_THRESHOLD) -> Column:
    """1 where 1 - distance / longer length of two columns reaches the threshold.

    The plain edit distance, which the JVM computes within a bound, is at least this
    distance and at most twice it; only pairs between the two are scored in full, and of
    these none where one text has more characters that the other lacks than edits are
    left: an edit takes away one character at most.
    """
    a, b = named(left), named(right)
    edits = f"cast(floor(greatest(length({a}), length({b})) * {1 - threshold!r}D + {SLACK!r}D) as int)"
    plain = F.expr(f"levenshtein({a}, {b}, 2 * {edits})")
    near = (plain >= 0) & (plain <= F.expr(edits))
    lost = F.expr(f"greatest(length(translate({a}, {b}, '')), length(translate({b}, {a}, ''))) <= {edits}")
    rest = _scored(quoted(left), quoted(right), damerau_levenshtein_scores, (plain > F.expr(edits)) & lost)
    filled = F.expr(f"{a} <> '' and {b} <> ''")
    return F.when(filled & near, F.lit(1).cast("bigint")).otherwise(threshold_feature(rest, threshold - SLACK))


# --- tokens for candidate joins, as SQL of an array of strings

def rarity_bucket(token: str) -> str:
    return f"cast(pmod(xxhash64({token}), {RARITY_BUCKETS}) as int)"


def _rarest_first(entries: str, rarity: Sequence[int]) -> str:
    """(g, k) entries in one order shared by all records: rare hash buckets first."""
    table = f"cast(split('{','.join(map(str, rarity))}', ',') as array<bigint>)"
    ranked = f"named_struct('f', get({table}, {rarity_bucket('e.g')}), 'g', e.g, 'k', e.k)"
    return f"array_sort(transform({entries}, e -> {ranked}))"


def cosine_tokens(vector: str, rarity: Sequence[int], threshold: float) -> str:
    """Grams up to where the rest of the vector can no longer reach the threshold alone."""
    entries = f"transform(map_entries({vector}.grams), e -> named_struct('g', e.key, 'k', e.value))"
    rest = "aggregate(slice(o, i + 1, size(o)), 0, (t, x) -> t + x.k * x.k)"
    least = f"{vector}.norm * {vector}.norm * {threshold * threshold * (1 - SLACK)!r}D"
    marked = f"transform(o, (e, i) -> named_struct('g', e.g, 'rest', {rest}))"
    return let("o", _rarest_first(entries, rarity), f"transform(filter({marked}, e -> e.rest >= {least}), e -> e.g)")


def _first(parts: str, rarity: Sequence[int], count: str, lead: str) -> str:
    """The rarest ``count`` parts, each numbered by how often it stood before."""
    before = "size(filter(slice(ps, 1, i), x -> x = g))"
    numbered = let("ps", parts, f"transform(ps, (g, i) -> named_struct('g', g, 'k', {before}))")
    return f"transform(slice({_rarest_first(numbered, rarity)}, 1, {count}), e -> concat({lead}, e.g, e.k))"


def characters(text: str) -> str:
    return f"filter(split({text}, ''), c -> c <> '')"


def padded_bigrams(text: str) -> str:
    return f"regexp_extract_all(concat(char(2), {text}, char(3)), r'{OVERLAPPING_ANY}', 1)"


def damerau_tokens(text: str, rarity: Sequence[int], threshold: float) -> str:
    """An edit destroys at most three padded bigrams, so 3k + 1 rare ones cannot all be lost."""
    longest = f"floor(length({text}) / {threshold!r}D + {SLACK!r}D)"
    edits = f"floor({longest} * {1 - threshold!r}D + {SLACK!r}D)"
    tokens = _first(padded_bigrams(text), rarity, f"cast({edits} * 3 + 1 as int)", "''")
    return f"case when {text} <> '' then {tokens} end"


def jaro_winkler_tokens(text: str, rarity: Sequence[int], threshold: float) -> str:
    """Characters that a pair must share.

    Without an equal first character the plain Jaro score has to reach the
    threshold; with one, the score that four equal first characters can raise to it.
    """
    def count(jaro: float) -> str:
        must = f"greatest(ceil(length({text}) * {max(3 * jaro - 2, 0.0)!r}D - {SLACK!r}D), 1)"
        return f"cast(length({text}) - {must} + 1 as int)"

    plain = _first(characters(text), rarity, count(threshold), "'='")
    led = _first(characters(text), rarity, count((threshold - 0.4) / 0.6), f"substr({text}, 1, 1)")
    return f"case when {text} <> '' then concat({plain}, {led}) end"
