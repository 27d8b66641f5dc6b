"""Record linkage between two tables: rules, candidates, features, scores, output.

Every match is a pair that shares a block and reaches the threshold in at least
one feature. Where the blocks are small, the rows of a block are paired and
scored at once. Where pairing whole blocks would grow with the square of a
block, equal records are first folded into profiles, and two profiles of a block
meet only if they share a token of some feature; tokens are chosen so that no
pair with a hit can be missed. Both ways give the same pairs.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadmill import fixed_values as fixed
from leadmill.functions import similarity as S, values as V
from leadmill.functions.values import quoted
from leadmill.operators.candidates import block_keys, neighbour_keys
from leadmill.operators.columns import clean_column_names, fill_missing, lowercase_strings
from leadmill.operators.joins import KeyLoad, attach, deal_sides, key_counts, key_load, pair_up, spread
from leadmill.session import materialise

# blocks are paired whole while the pairs stay within a small multiple of the rows
PAIRS_PER_ROW = 16
PAIRS_AT_LEAST = 2_000_000
# rows whose vectors one task sorts, and pairs that one task makes of profiles, about
ROWS_PER_TASK = 100_000
PAIRS_PER_TASK = 20_000_000
# pairs of ids that are made by as few tasks as their bytes ask for, and pairs that fill a task which scores them
PAIRED_AT_ONCE = 1_000_000
SCORED_AT_LEAST = 2_000

EXACT, COSINE, JARO_WINKLER, DAMERAU = "exact", "cosine", "jarowinkler", "damerau_levenshtein"


@dataclass(frozen=True)
class Feature:
    left: str
    right: str
    label: str
    method: str


@dataclass(frozen=True)
class LinkPlan:
    """Columns to block on, columns to sort by, and columns to compare."""

    blocks: tuple[tuple[str, str], ...]
    neighbours: tuple[tuple[str, str], ...]
    features: tuple[Feature, ...]
    notes: tuple[str, ...] = field(default=())

    def __post_init__(self) -> None:
        for tag, vectors, columns in (
            ("left", self.left_vectors, [f.left for f in self.features if f.method != COSINE]),
            ("right", self.right_vectors, [f.right for f in self.features if f.method != COSINE]),
        ):
            if set(vectors) & set(columns):
                raise ValueError(f"{tag} columns compared in two ways: {sorted(set(vectors) & set(columns))}")

    @property
    def labels(self) -> list[str]:
        return [f.label for f in self.features]

    @property
    def left_vectors(self) -> list[str]:
        return [f.left for f in self.features if f.method == COSINE]

    @property
    def right_vectors(self) -> list[str]:
        return [f.right for f in self.features if f.method == COSINE]


# --- rules

def link_rules(match_type: str | Mapping, presets: Mapping = fixed.LINK_RULES) -> Mapping:
    if isinstance(match_type, Mapping):
        return match_type
    if match_type not in presets:
        raise ValueError(f"unknown match type {match_type!r}; known: {', '.join(presets)}")
    return presets[match_type]


def _column_pairs(rules: Mapping | None) -> list[tuple[str, str]]:
    """(key, column) pairs of a rule table whose values are a column, a list or nothing."""
    pairs = []
    for key, columns in (rules or {}).items():
        listed = columns if isinstance(columns, (list, tuple)) else [columns]
        pairs += [(key, column) for column in listed if column is not None]
    return pairs


def missing_columns(
    left: DataFrame, right: DataFrame, rules: Mapping, keyed_by: str = "left"
) -> tuple[list[str], list[str]]:
    """Rule columns that the left and the right table lack."""
    index = rules.get("index", {})
    pairs = [p for table in (index.get("block"), index.get("sortedneighbour"), rules.get("compare"))
             for p in _column_pairs(table)]
    if keyed_by == "right":
        pairs = [(column, key) for key, column in pairs]
    return (
        [a for a, _ in pairs if a not in left.columns],
        [b for _, b in pairs if b not in right.columns],
    )


def make_plan(
    left: DataFrame,
    right: DataFrame,
    rules: Mapping,
    method: str = COSINE,
    keyed_by: str = "left",
) -> LinkPlan:
    """Turn a rule table into a plan; columns of unlike types are not compared, which a warning says."""
    lost_left, lost_right = missing_columns(left, right, rules, keyed_by)
    if lost_left or lost_right:
        raise ValueError(f"columns missing on the left: {lost_left}, on the right: {lost_right}")

    def sides(key: str, column: str) -> tuple[str, str]:
        return (key, column) if keyed_by == "left" else (column, key)

    features, notes = [], []
    for key, column in _column_pairs(rules.get("compare")):
        a, b = sides(key, column)
        kind = V.data_type(left, a)
        if V.family(kind) != V.family(V.data_type(right, b)):
            notes.append(f"{a} and {b} differ in type and are not compared")
            continue
        chosen = method if isinstance(kind, T.StringType) else EXACT
        features.append(Feature(a, b, f"{key.replace('SF_', 'Match_')}_{column}", chosen))
    for note in notes:
        warnings.warn(note, stacklevel=2)
    index = rules.get("index", {})
    return LinkPlan(
        tuple(sides(*p) for p in _column_pairs(index.get("block"))),
        tuple(sides(*p) for p in _column_pairs(index.get("sortedneighbour"))),
        tuple(features),
        tuple(notes),
    )


# --- features of a pair

def _feature(f: Feature) -> Column:
    if f.method == COSINE:
        score = F.expr(S.vector_cosine(S.named(f"l:{f.left}"), S.named(f"r:{f.right}")))
        return S.threshold_feature(score)
    if f.method == EXACT:
        return S.exact_feature(quoted(f"l:{f.left}"), quoted(f"r:{f.right}"))
    edit = S.jaro_winkler_feature if f.method == JARO_WINKLER else S.damerau_levenshtein_feature
    return edit(f"l:{f.left}", f"r:{f.right}")


def _score(pairs: DataFrame, plan: LinkPlan, ids: Sequence[str]) -> DataFrame:
    """Ids and 0/1 features of the pairs that have at least one hit.

    The features pass through a generator, which the filter cannot be pushed
    below: otherwise every similarity would be computed for the filter and again
    for the output.
    """
    features = F.struct(*[_feature(f).alias(f.label) for f in plan.features])
    scored = pairs.select(*map(quoted, ids), features.alias("__f"))
    unpacked = scored.select(*map(quoted, ids), F.inline(F.array("__f")))
    return unpacked.where(reduce(lambda a, b: a + b, map(quoted, plan.labels)) >= 1)


def _narrow(side: DataFrame, own_id: str, tag: str, columns: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """Id, extra columns and the compare columns under tagged names; -0.0 becomes 0.0."""
    def value(c: str) -> Column:
        kind = V.data_type(side, c)
        number = V.nan_to_null(quoted(c), kind)
        return number + F.lit(0.0).cast(kind) if V.is_fractional(kind) else number

    values = [value(c).alias(tag + c) for c in dict.fromkeys(columns)]
    return side.select(quoted(own_id), *map(quoted, extra), *values)


def _with_vectors(narrow: DataFrame, tag: str, columns: Sequence[str]) -> DataFrame:
    """Texts compared by cosine turned into gram vectors, once per record."""
    names = [tag + c for c in dict.fromkeys(columns)]
    plain = narrow.withColumns({c: S.plain_text(quoted(c)) for c in names})
    return plain.withColumns({c: F.expr(S.gram_vector(S.named(c))) for c in names})


# --- pairs that share a block and a hit

def _whole_blocks(
    lefts: DataFrame, rights: DataFrame, plan: LinkPlan, left_id: str, right_id: str, load: KeyLoad
) -> DataFrame:
    """Pair and score the rows of each block.

    The plain columns are shuffled; gram vectors, which are larger, are made after
    the shuffle, in the tasks that pair the rows. Tasks grow in number with the rows,
    so that the vectors one of them sorts stay few.
    """
    a = _narrow(lefts, left_id, "l:", [f.left for f in plan.features], ["__block"])
    b = _narrow(rights, right_id, "r:", [f.right for f in plan.features], ["__block"])
    a, b, keys = deal_sides(a, b, ["__block"], load.skewed)
    a = _with_vectors(spread(a, keys, load.rows / ROWS_PER_TASK), "l:", plan.left_vectors)
    b = _with_vectors(spread(b, keys, load.rows / ROWS_PER_TASK), "r:", plan.right_vectors)
    return _score(a.join(b, keys), plan, [left_id, right_id])


def _token_sets(f: Feature, value: str, rarity: Sequence[int]) -> str:
    if f.method == EXACT:
        return f"case when {value} is not null then array(cast({value} as string)) end"
    tokens = {COSINE: S.cosine_tokens, JARO_WINKLER: S.jaro_winkler_tokens, DAMERAU: S.damerau_tokens}
    return tokens[f.method](value, rarity, fixed.MATCH_THRESHOLD)


def _parts(f: Feature, value: str) -> str:
    if f.method == COSINE:
        return f"map_keys({value}.grams)"
    return S.characters(value) if f.method == JARO_WINKLER else S.padded_bigrams(value)


def _rarity(a: DataFrame, b: DataFrame, plan: LinkPlan) -> list[list[int]]:
    """Per feature, how often each of RARITY_BUCKETS hash buckets of tokens occurs.

    Only the order of tokens hangs on it, never the result. Each side is read once for
    all features: a read per feature makes that many times the tasks, each with the
    metrics of all reads, which the driver keeps until the last has ended.
    """
    tables = [[0] * S.RARITY_BUCKETS for _ in plan.features]
    counted = []
    for side, names in ((a, [f"l:{f.left}" for f in plan.features]), (b, [f"r:{f.right}" for f in plan.features])):
        sets = [
            f"coalesce(transform({_parts(f, S.named(name))}, t -> {i * S.RARITY_BUCKETS} + {S.rarity_bucket('t')}), cast(array() as array<int>))"
            for i, (f, name) in enumerate(zip(plan.features, names, strict=True))
            if f.method != EXACT
        ]
        if sets:
            counted.append(side.selectExpr(f"explode(concat({', '.join(sets)})) as place"))
    if counted:
        for row in reduce(DataFrame.unionByName, counted).groupBy("place").count().collect():
            feature, bucket = divmod(row["place"], S.RARITY_BUCKETS)
            tables[feature][bucket] = row["count"]
    return tables


LOSSLESS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _profiles(side: DataFrame, columns: Sequence[str], own_id: str, pid: str) -> tuple[DataFrame, DataFrame]:
    """(distinct rows of the columns with a digest as id, digest beside each record id).

    The digest is computed row by row, so equal records fold on the map side and
    a hot record never travels more than once per task.
    """
    names = list(dict.fromkeys(columns))
    digest = F.unhex(F.sha2(F.to_json(F.struct(*map(quoted, names)), LOSSLESS), 256))
    marked = side.select(quoted(own_id), digest.alias(pid), *[quoted(c) for c in names if c != own_id])
    profiles = marked.dropDuplicates([pid])
    return profiles if own_id in names else profiles.drop(own_id), marked.select(pid, quoted(own_id))


def _shared_tokens(lefts: DataFrame, rights: DataFrame, plan: LinkPlan, left_id: str, right_id: str) -> DataFrame:
    """The same result as whole blocks, without pairing rows that have nothing in common.

    ``lefts`` and ``rights`` are profiles. Only a number of the record and a hash of
    block and token are dealt out by token; the pairs that meet are folded, and the
    values to compare, stored once for both steps, join them afterwards. Two hashes that
    clash make a candidate more, which the block and the score then refuse.
    """
    def stored(side: DataFrame, own_id: str, tag: str, columns: Sequence[str], vectors: Sequence[str]) -> DataFrame:
        made = _with_vectors(_narrow(spread(side, [own_id]), own_id, tag, columns, ["__block"]), tag, vectors)
        return materialise(made.select(F.monotonically_increasing_id().alias(f"__{tag[0]}n"), "*"), "numbered")

    a = stored(lefts, left_id, "l:", [f.left for f in plan.features], plan.left_vectors)
    b = stored(rights, right_id, "r:", [f.right for f in plan.features], plan.right_vectors)
    rarity = _rarity(a, b, plan)

    def tokens(side: DataFrame, tag: str, mine) -> DataFrame:
        sets = [
            f"transform(coalesce({_token_sets(f, S.named(tag + mine(f)), rarity[i])}, cast(array() as array<string>)), "
            f"t -> xxhash64({i}, t, __block))"
            for i, f in enumerate(plan.features)
        ]
        listed = side.select(f"__{tag[0]}n", F.expr(f"array_distinct(concat({', '.join(sets)}))").alias("__tokens"))
        return materialise(listed, "tokens").select(f"__{tag[0]}n", F.explode("__tokens").alias("__token"))

    met = pair_up(tokens(a, "l:", lambda f: f.left), tokens(b, "r:", lambda f: f.right), ["__token"])
    met = spread(materialise(met.select("__ln", "__rn").distinct(), "token-pairs"), ["__ln", "__rn"])
    a, b = a.withColumnRenamed("__block", "__lb"), b.withColumnRenamed("__block", "__rb")
    joined = attach(attach(met, a, ["__ln"], "inner"), b, ["__rn"], "inner").where("__lb = __rb")
    return _score(joined, plan, [left_id, right_id])


@dataclass(frozen=True)
class Linked:
    """Matching pairs, of records or of profiles.

    Where ``lefts`` and ``rights`` are given, ``pairs`` holds (__lp, __rp, features)
    and these hold the records (__lp, left id) and (__rp, right id) of each profile;
    every record of the one matches every record of the other. Otherwise ``pairs``
    holds (left id, right id, features). ``unique``: no id repeats or is null.
    ``by_id``: two ids match once, whatever the number of their records that match.
    """

    pairs: DataFrame
    lefts: DataFrame | None = None
    rights: DataFrame | None = None
    unique: bool = False
    by_id: bool = False

    def with_pairs(self, change) -> Linked:
        return replace(self, pairs=change(self.pairs))

    def records(self, left_id: str, right_id: str) -> DataFrame:
        """(left id, right id, features) of all pairs."""
        if self.lefts is None:
            return self.pairs
        folded = self.ids_folded(left_id, right_id)
        features = [c for c in folded.pairs.columns if c not in ("__lp", "__rp")]
        met = members_met(folded.pairs, folded.lefts, folded.rights)
        return met.select(quoted(left_id), quoted(right_id), *map(quoted, features))

    def ids_folded(self, left_id: str, right_id: str) -> Linked:
        """The pairs between classes of ids instead of profiles, so that no two ids meet twice.

        Where the records of two ids match in several ways, the largest features stand.
        """
        if not self.by_id:
            return self
        features = [c for c in self.pairs.columns if c not in ("__lp", "__rp")]
        lefts, left_classes = _id_classes(self.lefts, left_id, "__lp")
        rights, right_classes = _id_classes(self.rights, right_id, "__rp")

        def classed(pairs: DataFrame, classes: DataFrame, pid: str) -> DataFrame:
            return pair_up(pairs, classes, [pid]).withColumn(pid, F.col("__class")).drop("__class")

        by_left = classed(self.pairs, left_classes, "__lp")
        met = by_left.unionByName(classed(self.pairs.unionByName(by_left), right_classes, "__rp"))
        best = met.groupBy("__lp", "__rp").agg(F.max(F.struct(*map(quoted, features))).alias("__f"))
        pairs = self.pairs.unionByName(best.select("__lp", "__rp", "__f.*"))
        return replace(self, pairs=materialise(pairs, "id-pairs"), lefts=lefts, rights=rights, by_id=False)


def _id_classes(members: DataFrame, own_id: str, pid: str) -> tuple[DataFrame, DataFrame]:
    """(each id once, beside its class; classes of several profiles beside each of these).

    Ids whose records have the same profiles are one class: the profile itself where
    there is one, otherwise a digest of four hashes over the profiles, combined as they
    come, so that the profiles of an id that stands for many records never meet. A
    missing id is an id here.
    """
    keyed = members.select(pid, F.struct(quoted(own_id)).alias("__id")).distinct()
    count = F.count(F.lit(1))
    hashes = [F.bit_xor(F.xxhash64(F.lit(i), pid)).cast("string") for i in range(4)]
    several = F.unhex(F.sha2(F.concat_ws(",", count.cast("string"), *hashes), 256))
    folded = keyed.groupBy("__id").agg(F.when(count == 1, F.min(pid)).otherwise(several).alias("__class"), (count > 1).alias("__several"))
    classes = materialise(folded, "id-classes")
    shared = attach(keyed, classes.where("__several"), ["__id"], "inner").select("__class", pid).distinct()
    ids = classes.select(F.col("__class").alias(pid), F.col("__id").getField(own_id).alias(own_id))
    return ids, materialise(shared, "shared-ids")


def members_met(pairs: DataFrame, lefts: DataFrame, rights: DataFrame) -> DataFrame:
    """The rows of both sides for each pair of profiles; ``pairs`` is stored and read a few times.

    The side that makes fewer rows joins the pairs first. The other join makes the
    rows of the result, and nothing is shuffled after it.
    """
    counts = key_counts(lefts, ["__lp"], "__nl"), key_counts(rights, ["__rp"], "__nr")
    by_left, by_right, rows = (
        pairs.join(counts[0], "__lp").join(counts[1], "__rp")
        .agg(F.sum("__nl"), F.sum("__nr"), F.sum(F.col("__nl").cast("double") * F.col("__nr"))).first()
    )
    first, by, last, on = (lefts, "__lp", rights, "__rp") if (by_left or 0) < (by_right or 0) else (rights, "__rp", lefts, "__lp")
    half = pair_up(pairs, first, [by]).drop(by)
    a, b, keys = deal_sides(half, last, [on])
    return spread(a, keys, (rows or 0.0) / PAIRS_PER_TASK).join(spread(b, keys, (rows or 0.0) / PAIRS_PER_TASK), keys)


def _unique(side: DataFrame, own_id: str) -> bool:
    """Whether no id of a table repeats or is null."""
    return side.groupBy(quoted(own_id).alias("id")).count().where("id is null or count > 1").isEmpty()


def matching_pairs(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    plan: LinkPlan,
    whole_blocks: bool | None = None,
) -> DataFrame:
    """(left id, right id, 0/1 features) of all pairs with a block and a hit in common.

    ``whole_blocks`` forces one of the two ways; by default the sizes of the
    blocks decide for each rule.
    """
    return linked_pairs(left, right, left_id, right_id, plan, whole_blocks).records(left_id, right_id)


def linked_pairs(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    plan: LinkPlan,
    whole_blocks: bool | None = None,
) -> Linked:
    """The pairs of ``matching_pairs``, kept between profiles where whole blocks would be too many pairs.

    With several rules, ids that repeat or are null match once; they are folded into
    classes before any pair of records is made.
    """
    if left_id == right_id:
        raise ValueError("the two id columns need different names")
    left = V.widened(left, [f.left for f in plan.features])
    right = V.widened(right, [f.right for f in plan.features])
    if not plan.features or not (plan.blocks or plan.neighbours):
        raise ValueError("a linkage needs at least one index rule and one comparison")
    rules = [] if whole_blocks is False else _sided(left, right, left_id, right_id, plan)
    wholes = [_is_whole(load, whole_blocks) for _, _, load in rules] or [False] * len(_index_rules(plan))
    if all(wholes):
        return Linked(_rule_pairs(rules, wholes, left, right, left_id, right_id, plan))
    unique = _unique(left, left_id) and _unique(right, right_id)
    folded = _folded(left, right, left_id, right_id, plan, whole_blocks, unique)
    return folded if unique or len(wholes) == 1 else replace(folded, by_id=True)


def _index_rules(plan: LinkPlan) -> list[tuple[str, tuple[str, str]]]:
    return [("blocks", on) for on in plan.blocks] + [("neighbours", on) for on in plan.neighbours]


def _sided(left: DataFrame, right: DataFrame, left_id: str, right_id: str, plan: LinkPlan) -> list[tuple[DataFrame, DataFrame, KeyLoad]]:
    """Per index rule both sides with their block keys, and what they would meet."""
    sided = []
    for kind, (a, b) in _index_rules(plan):
        keys = block_keys if kind == "blocks" else neighbour_keys
        lefts, rights = keys(
            left.select(*map(quoted, dict.fromkeys([left_id, *[f.left for f in plan.features], a]))),
            right.select(*map(quoted, dict.fromkeys([right_id, *[f.right for f in plan.features], b]))),
            a,
            b,
        )
        sided.append((lefts, rights, key_load(lefts, rights, ["__block"])))
    return sided


def _is_whole(load: KeyLoad, whole_blocks: bool | None) -> bool:
    return load.pairs <= max(PAIRS_AT_LEAST, PAIRS_PER_ROW * load.rows) if whole_blocks is None else whole_blocks


def _rule_pairs(
    rules: Sequence[tuple[DataFrame, DataFrame, KeyLoad]], wholes: Sequence[bool], left: DataFrame, right: DataFrame,
    left_id: str, right_id: str, plan: LinkPlan,
) -> DataFrame:
    """Scored pairs of all rules, each rule by whole blocks or by tokens; ids do not repeat where tokens are used."""
    several = len(rules) > 1
    found, candidates = [], []
    for rule, ((lefts, rights, load), whole) in enumerate(zip(rules, wholes, strict=True)):
        if whole and several:
            candidates.append(_block_pairs(lefts, rights, left_id, right_id, load).withColumn("__rule", F.lit(1 << rule)))
        elif whole:
            found.append(_whole_blocks(lefts, rights, plan, left_id, right_id, load))
        else:
            found.append(_shared_tokens(lefts, rights, plan, left_id, right_id))
    if candidates:
        pairs = sum(load.pairs for (_, _, load), whole in zip(rules, wholes, strict=True) if whole)
        found.append(_scored_once(reduce(DataFrame.unionByName, candidates), left, right, plan, left_id, right_id, pairs))
    if len(found) == 1:
        return found[0]
    return reduce(DataFrame.unionByName, found).dropDuplicates([left_id, right_id])


def _folded(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, plan: LinkPlan, whole_blocks: bool | None, unique: bool
) -> Linked:
    """Equal records folded into profiles over all index and compare columns, and the profiles matched."""
    indexed = [on for _, on in _index_rules(plan)]
    profiles, members = [], []
    for side, own_id, pid, at in ((left, left_id, "__lp", 0), (right, right_id, "__rp", 1)):
        columns = [*[on[at] for on in indexed], *[(f.left, f.right)[at] for f in plan.features]]
        made, own = _profiles(side, columns, own_id, pid)
        profiles.append(materialise(made, "profiles"))
        members.append(materialise(own, "members"))
    rules = _sided(*profiles, "__lp", "__rp", plan)
    wholes = [_is_whole(load, whole_blocks) for _, _, load in rules]
    pairs = materialise(_rule_pairs(rules, wholes, *profiles, "__lp", "__rp", plan), "profile-pairs")
    return Linked(pairs, *members, unique)


def _block_pairs(lefts: DataFrame, rights: DataFrame, left_id: str, right_id: str, load: KeyLoad) -> DataFrame:
    """(__l, __r): ids of all pairs that share a block of one rule, nothing else carried."""
    a = lefts.select(quoted(left_id).alias("__l"), "__block")
    b = rights.select(quoted(right_id).alias("__r"), "__block")
    a, b, keys = deal_sides(a, b, ["__block"], load.skewed)
    if max(load.rows, load.pairs) > PAIRED_AT_ONCE:
        a, b = spread(a, keys), spread(b, keys)
    return a.join(b, keys).select("__l", "__r")


def candidate_table(candidates: DataFrame) -> DataFrame:
    """(__l, __r, __rules): each pair once, with the bits of the rules that found it, by one aggregation."""
    return candidates.groupBy("__l", "__r").agg(F.bit_or("__rule").alias("__rules"))


def _scored_once(
    candidates: DataFrame, left: DataFrame, right: DataFrame, plan: LinkPlan, left_id: str, right_id: str, count: float
) -> DataFrame:
    """Features of each distinct candidate pair, computed once whatever the number of rules that found it.

    The compare columns join the pairs by id, hot ids through a broadcast of their rows.
    ``count``: pairs of all rules, which bounds the tasks worth having.
    """
    a = _with_vectors(_narrow(left, left_id, "l:", [f.left for f in plan.features], []), "l:", plan.left_vectors)
    b = _with_vectors(_narrow(right, right_id, "r:", [f.right for f in plan.features], []), "r:", plan.right_vectors)
    dealt = spread(candidates, ["__l", "__r"], work=count / SCORED_AT_LEAST)
    pairs = candidate_table(dealt).select(F.col("__l").alias(left_id), F.col("__r").alias(right_id))
    met = attach(attach(pairs, a, [left_id], "inner"), b, [right_id], "inner")
    return _score(met, plan, [left_id, right_id])


# --- scores

def add_score(pairs: DataFrame, labels: Sequence[str], name: str = "Match_zScore") -> DataFrame:
    """Sum of the features named ``Match_``."""
    own = [quoted(c) for c in labels if "Match_" in c]
    return pairs.withColumn(name, reduce(lambda a, b: a + b, own) if own else F.lit(0).cast("bigint"))


def add_confidence(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Weighted percentage of the attribute groups with a hit, its bin, and account hits."""
    def hits(pattern: str) -> Column:
        parts = [quoted(c) for c in labels if re.search(pattern, c)]
        return reduce(lambda a, b: a + b, parts) if parts else F.lit(0).cast("bigint")

    weights = fixed.CONFIDENCE_WEIGHTS
    points = reduce(
        lambda a, b: a + b, [F.when(hits(p) > 0, F.lit(w)).otherwise(F.lit(0)) for p, w in weights.items()]
    )
    percent = V.round_half_even(points / F.lit(float(sum(weights.values()))) * 100).cast("bigint")
    return (
        pairs.withColumn("Match_zAccount", hits(fixed.ACCOUNT_FEATURES))
        .withColumn("Match_zConfidence", percent)
        .withColumn(
            "Match_zConfidence_bins", V.bin_label(F.col("Match_zConfidence"), fixed.CONFIDENCE_BIN_EDGES)
        )
    )


# --- output

def join_output(
    leading: DataFrame,
    pairs: DataFrame,
    other: DataFrame,
    lead_id: str,
    other_id: str,
    suffixes: tuple[str, str],
    small: bool | None = None,
) -> DataFrame:
    """Every leading row with its matches and their other side; clashing names get suffixes.

    ``pairs`` should be stored: it is read twice. Matched and unmatched rows are
    joined apart, so that a leading row with very many matches stays on a side
    that adaptive execution or the hot-key path can split. ``small`` as in ``attach``.
    """
    lead, tail = _suffixed(leading, other, lead_id, other_id, suffixes)
    matched = attach(attach(pairs, lead, [lead_id], "inner", small), tail, [other_id], small=small)
    partners = pairs.select(quoted(lead_id)).distinct()
    alone = lead.join(partners, lead_id, "left_anti")
    return _ordered(matched, alone, lead, pairs, tail, lead_id, other_id)


def _suffixed(
    leading: DataFrame, other: DataFrame, lead_id: str, other_id: str, suffixes: tuple[str, str]
) -> tuple[DataFrame, DataFrame]:
    clash = [c for c in leading.columns if c in other.columns and c not in (lead_id, other_id)]
    lead = leading.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    tail = other.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    tail = tail if lead_id not in tail.columns else tail.withColumnRenamed(lead_id, lead_id + suffixes[1])
    lead = lead if other_id not in lead.columns else lead.withColumnRenamed(other_id, other_id + suffixes[0])
    return lead, tail


def _ordered(
    matched: DataFrame, alone: DataFrame, lead: DataFrame, pairs: DataFrame, tail: DataFrame, lead_id: str, other_id: str
) -> DataFrame:
    features = [c for c in pairs.columns if c not in (lead_id, other_id, "__lp", "__rp")]
    order = [lead_id, *[c for c in lead.columns if c != lead_id], *features, other_id,
             *[c for c in tail.columns if c != other_id]]
    return matched.unionByName(alone, allowMissingColumns=True).select(*map(quoted, order))


def linked_output(
    left: DataFrame,
    linked: Linked,
    right: DataFrame,
    left_id: str,
    right_id: str,
    suffixes: tuple[str, str],
    secondary: bool = False,
    small: bool | None = None,
) -> DataFrame:
    """``join_output`` of linked tables; ``secondary`` lets the right one lead.

    Pairs of profiles stay folded while both sides' columns join them by profile, so
    the pairs of records are made last and are neither stored nor shuffled, with ids
    that repeat or are null as well.
    """
    (leading, lead_id), (other, other_id) = ((right, right_id), (left, left_id)) if secondary else ((left, left_id), (right, right_id))
    if linked.lefts is None:
        return join_output(leading, materialise(linked.pairs, "pairs"), other, lead_id, other_id, suffixes, small)
    linked = linked.ids_folded(left_id, right_id)
    pairs = materialise(linked.pairs, "pairs")
    lead, tail = _suffixed(leading, other, lead_id, other_id, suffixes)
    pid, own, others = ("__rp", linked.rights, linked.lefts) if secondary else ("__lp", linked.lefts, linked.rights)
    partners = pairs.select(pid).distinct()
    if linked.unique:
        leads, tails = own.join(lead, lead_id), others.join(tail, other_id)
        alone = leads.join(partners, pid, "left_anti")
    else:
        met = own.join(partners, pid, "left_semi")
        leads = pair_up(met, lead, [lead_id])
        tails = pair_up(others, tail, [other_id]).unionByName(others.where(quoted(other_id).isNull()), allowMissingColumns=True)
        alone = lead.join(met.select(quoted(lead_id)).distinct(), lead_id, "left_anti")
    matched = members_met(pairs, *((tails, leads) if secondary else (leads, tails)))
    return _ordered(matched, alone, lead, pairs, tail, lead_id, other_id)


def _whole_features(df: DataFrame) -> DataFrame:
    """Feature columns as integers with gaps as 0; bins keep their text."""
    names = [c for c in df.columns if "Match_" in c and "_bins" not in c]
    return df.withColumns({c: V.to_long(quoted(c), V.data_type(df, c)) for c in names})


def link_records(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    match_type: str | Mapping,
    confidence_score: bool = False,
    secondary: bool = False,
    whole_blocks: bool | None = None,
) -> DataFrame:
    """Match two tables and give every row of the leading one with its matches.

    ``secondary`` lets the right table lead.
    """
    plan = make_plan(left, right, link_rules(match_type))
    linked = linked_pairs(left, right, left_id, right_id, plan, whole_blocks).with_pairs(lambda pairs: add_score(pairs, plan.labels))
    if confidence_score:
        linked = linked.with_pairs(lambda pairs: add_confidence(pairs, plan.labels))
    suffixes = ("_df2", "_df1") if secondary else ("_df1", "_df2")
    return _whole_features(linked_output(left, linked, right, left_id, right_id, suffixes, secondary))


def match_records(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    match_type: str | Mapping,
    whole_blocks: bool | None = None,
) -> DataFrame:
    """The older matcher: rules keyed by the right column, Jaro-Winkler on text.

    Gives the input columns, then the sorted match and account columns, gaps 0.
    """
    rules = link_rules(match_type, fixed.OLD_LINK_RULES)
    plan = make_plan(left, right, rules, JARO_WINKLER, keyed_by="right")
    linked = linked_pairs(left, right, left_id, right_id, plan, whole_blocks).with_pairs(lambda pairs: add_score(pairs, plan.labels))
    joined = linked_output(left, linked, right, left_id, right_id, ("_df1", "_df2"))
    inputs = [left_id, *[c for c in joined.columns if c in left.columns and c != left_id]]
    added = sorted(c for c in joined.columns if c.startswith(("Match_", "SF_")) and c not in inputs)
    return joined.select(*map(quoted, [*inputs, *added])).na.fill(0)


# --- the oldest matcher

def field_mapping(kind: str) -> dict[str, str]:
    """Right column -> left column of a preset."""
    if kind not in fixed.FIELD_MAPPINGS:
        raise ValueError(f"unknown mapping {kind!r}; known: {', '.join(fixed.FIELD_MAPPINGS)}")
    return plain_mapping(fixed.FIELD_MAPPINGS[kind])


def plain_mapping(fields: Mapping[str, str | Mapping[str, str]]) -> dict[str, str]:
    return {key: value if isinstance(value, str) else value["on"] for key, value in fields.items()}


def string_features(fields: Mapping[str, str]) -> tuple[Feature, ...]:
    return tuple(
        Feature(value, key, f"Match_{key.replace('SF_', '')}", JARO_WINKLER if key == "SF_CleanName" else DAMERAU)
        for key, value in fields.items()
    )


def potential_matches(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    fields: Mapping[str, str | Mapping[str, str]],
    whole_blocks: bool | None = None,
) -> DataFrame:
    """Pairs with a hit in a feature that was indexed, all text compared in lower case."""
    return potential_links(left, right, left_id, right_id, fields, whole_blocks).records(left_id, right_id)


def potential_links(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    fields: Mapping[str, str | Mapping[str, str]],
    whole_blocks: bool | None = None,
) -> Linked:
    """``potential_matches``, pairs of profiles left folded for ``format_matches``."""
    fields = plain_mapping(fields)
    lower_left, lower_right = lowercase_strings(left, [left_id]), lowercase_strings(right, [right_id])
    blocks, neighbours, indexed = [], [], []
    if "SF_AccountName" in fields:
        indexed.append("Match_AccountName")
        neighbours.append((fields["SF_AccountName"], "SF_AccountName"))
    if "SF_CleanName" in fields:
        indexed.append("Match_CleanName")
        if "SF_AccountName" in fields:
            blocks.append((fields["SF_AccountName"], "SF_CleanName"))
        neighbours.append((fields["SF_CleanName"], "SF_CleanName"))
    if "SF_CleanWebsite" in fields:
        indexed.append("Match_CleanWebsite")
        blocks.append((fields["SF_CleanWebsite"], "SF_CleanWebsite"))
    plan = LinkPlan(tuple(blocks), tuple(neighbours), string_features(fields))
    hit = reduce(lambda a, b: a + b, map(quoted, indexed))
    linked = linked_pairs(lower_left, lower_right, left_id, right_id, plan, whole_blocks)
    return linked.with_pairs(lambda pairs: add_score(pairs.where(hit > 0), plan.labels, "Match_Score"))


def format_matches(
    matches: DataFrame | Linked, left: DataFrame, right: DataFrame, left_id: str, right_id: str, small: bool | None = None
) -> DataFrame:
    """Input columns, then match and account columns, under clean names with gaps filled."""
    linked = matches if isinstance(matches, Linked) else Linked(matches)
    joined = linked_output(left, linked, right, left_id, right_id, ("_x", "_y"), small=small)
    joined = joined.toDF(*clean_column_names(joined.columns))
    inputs = clean_column_names([left_id, *[c for c in left.columns if c != left_id]])
    added = [c for c in joined.columns if c.startswith(("Match_", "SF_")) and c not in inputs]
    return fill_missing(joined.select(*map(quoted, [*inputs, *added])))
