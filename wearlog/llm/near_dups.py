"""Near duplicates by bottom-k sketches of word shingles.

A document's set is its distinct five-word shingles (ASCII letters in lower
case; all words as one shingle if fewer), each a 64-bit hash; its sketch is the
64 least hashes. Documents with equal sets form a class and only the classes are
compared. Two are linked when 100 * shared >= 85 * united, counted on full sets
(or by another ``similarity`` of at least 3/4, from which the figures follow).

Candidates: inverted lists of each class's 32 least values. A list of at most
``LIST`` classes gives its pairs (sizes must allow the similarity). A longer list
never does: only classes of whose values at least half are in such lists (others
share a value of a short list with any partner) go on, with their full sets, to
rounds over lists whose members are not all joined yet:

* A list of at most ``LIST`` members, or with at most ``FEW`` outside its largest group,
  gives its pairs across groups; a pair comes from the first list it has in common.
* Any other list gets a pivot (the member in most long lists), and every member one
  comparison with it: near ones are joined by that. A set is then known by its
  difference from the pivot (values it has more, values it lacks). Two sets differ
  where their differences do, so sets that are near each other, one of them not near
  the pivot, share values of their differences: more than
  ``(|Dz| - b (|z| - |p|)) / 2`` of a member z near the pivot p, at least
  ``|Dz| - (1 - t) / t |z|`` of any other (t the similarity, b = (1 - t) / (1 + t)).
  So one of each set's rarest differences (all but that many and one more) is
  shared, and those make the next round's lists: edits instead of common text.
  A set's values that no other has are in no list: they count, but are not dealt out.
* A member less than half alike to the pivot cannot be near one that is 1.5 - t alike
  or more (Jaccard distance is a metric); those less alike than that have lists by the
  rarest values of their own sets, too.

Every pair of a list is thus linked, joined already, in a list of the next round, or
excluded by proof. Once all lists together have at most ``LIST`` pairs a set left, those
are met at once; lists left after ``ROUNDS`` rounds are met member by member. Components
already known are single nodes for further links.

A pair goes on if the similarity estimated from the least 64 values of both
sketches together is at most 4.5 standard errors too low. Exact counts come
first for each class's best pair; of the others only pairs that still join two
components are counted.

Miss rates for a pair at the threshold: about 1e-25 by the short lists, 1e-5 by
the estimate. Null and blank texts have the empty set and
no links. A null id has no class: its row has a null component and is kept.
Rows that repeat an id are one node. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearlog.llm.links import components, joined_further, together
from wearlog.llm.words import LOWER, SMALL_CHUNK, chunks, hash_spans, mix, spans
from wearlog.session import discard, materialize, small_batches

WORDS = 5
SHARED, UNITED = 85, 100
SKETCH = 64
INDEXED = 32
LIST = 64
#: So many members outside a list's largest group always meet all members.
FEW = 16
#: Rounds of pivots before what is left meets member by member.
ROUNDS = 5
#: Members at least so much alike to a pivot (in percent) have lists by differences.
HALF = 50
#: A pivot's set is dealt to so many partitions.
SALT = 32
#: Members of a long list that are centres in the first further round, and the factor from round to round.
ROUND, GROWTH = 16, 16
#: Values of all open sets (8 MB) up to which the rounds' tables are one partition each.
OPEN_VALUES = 1 << 20
#: Bits of the map of ids whose full sets are wanted (half a megabyte at any size of input).
MAP_BITS = 1 << 22


class Rule(NamedTuple):
    """Two sets are near when ``united`` * shared values >= ``shared`` * united values, 3/4 at least."""

    shared: int = SHARED
    united: int = UNITED

    @property
    def share(self) -> float:
        return self.shared / self.united

    @property
    def least(self) -> int:
        """Smaller sets are near only when equal: n shingles of n + 1 are too few."""
        return -(-self.shared // (self.united - self.shared)) if self.shared < self.united else 1

    @property
    def estimate(self) -> float:
        return self.share - 4.5 * (self.share * (1 - self.share) / SKETCH) ** 0.5

    @property
    def wide(self) -> int:
        """Percent: a set so much alike to a pivot is near none that is less than ``HALF`` alike to it."""
        return HALF + -(-100 * (self.united - self.shared) // self.united)

    @property
    def common(self) -> int:
        """Of ``INDEXED`` least values, so many at least are shared with any partner."""
        return int(INDEXED * self.share - 4.5 * (INDEXED * self.share * (1 - self.share)) ** 0.5)

    @property
    def often(self) -> int:
        """Of ``INDEXED`` values, so many in long lists that a class with fewer shares a value of a short list with any partner."""
        return min(INDEXED // 2, self.common)


_TURN = np.array([2 * j + 3 for j in range(WORDS)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(raw: np.ndarray, bounds: np.ndarray):
    """Each text's distinct shingle hashes, ascending, as int64 arrays."""
    data = LOWER[raw]
    starts, lens = spans(data, bounds)
    words = hash_spans(data, starts, lens)
    cuts = np.searchsorted(starts, bounds)
    n = max(0, len(words) - WORDS + 1)
    grams = np.zeros(n, np.uint64)
    for j in range(WORDS):
        grams += words[j : j + n] * _TURN[j]
    grams = mix(grams).view(np.int64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a >= WORDS:
            yield np.unique(grams[a : b - WORDS + 1])
        elif b > a:
            h = np.uint64(b - a)
            for j in range(a, b):
                h = mix(np.array([h ^ words[j]]))[0]
            yield np.array([h], np.uint64).view(np.int64)
        else:
            yield np.zeros(0, np.int64)


def _sets(batches, size: int | None):
    """Rows (doc_id, n, digest, values): the least ``size`` values, or all."""
    for batch in batches:
        ids = batch.column(0)
        for first, end, raw, bounds in chunks(batch.column(1), SMALL_CHUNK):
            sets = list(shingle_sets(raw, bounds))
            part = [s[:size] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(first, end - first),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.cumsum([0] + [len(s) for s in part], dtype=np.int32), pa.array(np.concatenate(part), pa.int64())),
                ],
                names=["doc_id", "n", "digest", "vals"],
            )


SET_ROWS = "doc_id long, n long, digest binary, vals array<long>"


def _near_sizes(n: str, m: str, rule: Rule):
    return (F.least(n, m) * rule.united) >= (F.greatest(n, m) * rule.shared)


def _unsent(df: DataFrame) -> DataFrame:
    """Rows with arrays for a join that sorts both sides: Spark takes an array for one value, so it would
    broadcast, through the driver, tables many times larger than its limit."""
    return df.hint("merge")


def _short_pairs(posts: DataFrame, key: str, rule: Rule) -> DataFrame:
    p, q = posts.select(key, F.col("id").alias("p"), F.col("n").alias("pn")), posts.select(key, F.col("id").alias("q"), F.col("n").alias("qn"))
    joined = p.join(q, key).where((F.col("p") < F.col("q")) & _near_sizes("pn", "qn", rule))
    return joined.select(F.col("p").alias("a"), F.col("q").alias("b"))


def _with_lengths(posts: DataFrame, key: str) -> DataFrame:
    """The posts of lists with two members at least, with the list's length."""
    sums = posts.groupBy(key).agg(F.count("*").alias("df")).where("df > 1")
    return posts.join(sums, key)


def candidates(classes: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a, b) of class ids that the inverted lists bring together, and the lists' posts of classes mostly in long lists."""
    posts = classes.where(f"n >= {rule.least}").select("id", "n", F.size("vals").alias("k"), F.explode(F.slice("vals", 1, INDEXED)).alias("v"))
    posts = materialize(_with_lengths(posts, "v"), "near-posts")
    # classes mostly made of values in long lists
    often = posts.where(f"df > {LIST}").groupBy("id").agg(F.countDistinct("v").alias("k_long"), F.max("k").alias("k"))
    often = often.where(f"{INDEXED} * k_long >= {rule.often} * least(k, {INDEXED}) and k_long >= 3")
    return _short_pairs(posts.where(f"df <= {LIST}"), "v", rule).distinct(), materialize(posts.join(often.select("id"), "id", "left_semi"), "near-often")


def _prefixes(sets: DataFrame, most) -> DataFrame:
    """Lists (v, sid, id, n) of each set's rarest values: the first ``most`` of its k, those that no set to be met has first, then by number of sets.

    sets: sid, id, n, g (tells one sid's sets apart), k, vals (its values, those aside that no other set has), outer (to be met: pairs without such a set are not wanted) and what ``most`` is made of.
    """
    vals = sets.withColumn("most", most).where("most > 0")
    return _first(_common(vals.select("sid", "id", "n", "g", "k", "most", "outer", F.explode("vals").alias("v"))))


def _common(vals: DataFrame) -> DataFrame:
    """Of sets given a row a value (sid, id, n, g, k, most, outer, v): vs, the values (df, v) that sets to be met and others share, the rarest first."""
    lists = vals.groupBy("v").agg(F.count("*").alias("df"), F.max("outer").alias("wanted")).where("df > 1 AND wanted").select("v", "df")
    return vals.join(lists, "v").groupBy("sid", "id", "n", "g", "k", "most").agg(F.sort_array(F.collect_set(F.struct("df", "v"))).alias("vs"))


def _first(common: DataFrame) -> DataFrame:
    """The lists (v, sid, id, n) of the first ``most`` values of sets given by :func:`_common`."""
    left = F.greatest(F.col("most").cast("int") - (F.col("k") - F.size("vs")), F.lit(0)).cast("int")
    return common.select("sid", "id", "n", F.explode(F.slice("vs", F.lit(1), left)).alias("x")).select(F.col("x.v").alias("v"), "sid", "id", "n")


def _own_prefix(share: float):
    """Two sets have one of so many rarest values in common if they share ``share`` of the values of either."""
    return F.col("k") - F.ceil(F.col("k") * share - 1e-9).cast("int") + 1


def _own(sets: DataFrame) -> DataFrame:
    """Sets, each to be met with any other, for :func:`_prefixes`."""
    return sets.select("sid", "id", "n", F.lit(0).cast("long").alias("g"), F.col("n").alias("k"), "vals", F.lit(True).alias("outer"))


def _apart(posts: DataFrame, joined: DataFrame) -> DataFrame:
    """The posts of lists whose members are in several groups, with the group, the list's largest group, its members outside that and its length."""
    rows = posts.join(joined, "id", "left").withColumn("own", F.coalesce("component", "id")).drop("component")
    sums = rows.groupBy("v", "own").agg(F.count("*").alias("m")).groupBy("v").agg(
        F.max_by("own", F.struct("m", "own")).alias("home"), (F.sum("m") - F.max("m")).alias("outside"), F.sum("m").alias("members")
    )
    return rows.join(sums.where("outside > 0"), "v")


def _across(chosen: DataFrame, apart: DataFrame, rule: Rule) -> DataFrame:
    """Pairs a < b (sids) of different groups and near sizes: ``chosen`` members of lists with all members."""
    p = chosen.select("v", F.col("sid").alias("p"), F.col("n").alias("pn"), F.col("own").alias("po"))
    q = apart.select("v", F.col("sid").alias("q"), F.col("n").alias("qn"), F.col("own").alias("qo"))
    met = p.join(q, "v").where((F.col("po") != F.col("qo")) & _near_sizes("pn", "qn", rule))
    return met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def _all_across(lists: DataFrame, rule: Rule) -> DataFrame:
    """All pairs a < b of different groups and near sizes that share a list.

    Two sets often share many; the join keeps a pair in the least of them alone. A
    pair has one member outside the list's largest group at least, the left one here
    (the one with the lesser sid if both are)."""
    held = lists.groupBy("sid").agg(F.sort_array(F.collect_set("v")).alias("vs"))
    rows = lists.join(_unsent(held), "sid").withColumn("outer", F.col("own") != F.col("home"))
    p = rows.where("outer").select("v", F.col("sid").alias("p"), F.col("n").alias("pn"), F.col("own").alias("po"), F.col("vs").alias("pv"))
    q = rows.select("v", F.col("sid").alias("q"), F.col("n").alias("qn"), F.col("own").alias("qo"), "outer", F.col("vs").alias("qv"))
    first = F.get(F.array_intersect("pv", "qv"), F.lit(0)) == F.col("v")
    met = p.join(_unsent(q), "v").where((F.col("po") != F.col("qo")) & (~F.col("outer") | (F.col("p") < F.col("q"))) & _near_sizes("pn", "qn", rule) & first)
    return met.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))


def _direct() -> str:
    """Lists whose pairs across groups are few."""
    return f"(members <= {LIST} OR outside <= {FEW})"


def _against_pivots(apart: DataFrame, whole: DataFrame, rule: Rule) -> DataFrame:
    """Each member of a long list against the list's pivot: sid, id, n, p (the pivot's sid), pid, pn, linked, alike (percent), k (the difference's size), vals (its values that two sets of ``whole`` have, if half alike), lacked (how many more of the pivot's values no other set has: all members lack them)."""
    long = apart.where(f"NOT {_direct()}")
    weight = long.groupBy("sid").agg(F.count("*").alias("lists"))
    pivots = long.join(weight, "sid").groupBy("v").agg(F.max_by("sid", F.struct("lists", -F.col("id"), "sid")).alias("p"))
    pairs = long.select("v", "sid").join(pivots, "v").where("sid <> p").select("sid", "p").distinct()
    salt = F.pmod(F.xxhash64("sid"), F.lit(SALT))
    sides = pairs.join(_unsent(whole), "sid").withColumn("salt", salt)
    centres = whole.join(pivots.select(F.col("p").alias("sid")).distinct(), "sid", "left_semi").select(
        F.col("sid").alias("p"), F.col("id").alias("pid"), F.col("n").alias("pn"), F.col("vals").alias("pv"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<bigint>")).alias("salt")
    )
    both = sides.join(_unsent(centres), ["p", "salt"]).withColumn("shared", F.size(F.array_intersect("vals", "pv")))
    united = F.col("n") + F.col("pn") - F.col("shared")
    both = both.withColumn("linked", F.col("shared") * rule.united >= united * rule.shared).withColumn("alike", F.floor(100 * F.col("shared") / united))
    signed = lambda c, sign: F.transform(c, lambda x: F.xxhash64(F.col("p"), x, F.lit(sign)))
    differs = F.concat(signed(F.array_except("vals", "pv"), 1), signed(F.array_except("pv", "vals"), -1))
    return both.select("sid", "id", "n", "p", "pid", "pn", "linked", "alike", (F.col("n") + F.col("pn") - 2 * F.col("shared")).alias("k"), (F.col("pn") - F.size("pv")).alias("lacked"), F.when(F.col("alike") >= HALF, differs).alias("vals"))


def _next_lists(met: DataFrame, whole: DataFrame, joined: DataFrame, rule: Rule) -> DataFrame:
    """Lists of the next round: by rarest differences from a pivot, or by a set's own rarest values.

    Only pairs of different components are wanted: differences from a pivot if a set
    half alike to it is not in its component (of the pivot's component those that may be
    near such a set by size and likeness to the pivot), own values of the sets far from a
    pivot if they are of several components and one is not half alike."""
    s, u = rule.shared, rule.united
    label = lambda x, c: joined.select(F.col("id").alias(x), F.col("component").alias(c))
    sides = met.join(label("id", "own"), "id", "left").join(label("pid", "home"), "pid", "left")
    sides = sides.withColumn("own", F.coalesce("own", "id")).withColumn("outer", F.col("own") != F.coalesce("home", "pid"))
    half = sides.where("vals IS NOT NULL")
    outer = half.where("outer").groupBy("p").agg(
        F.min("alike").alias("alike_from"), F.max("alike").alias("alike_to"), F.min("n").alias("n_from"), F.max("n").alias("n_to")
    )
    # near sets are this much alike to a pivot, too (percent, rounded down)
    reach = 1 - (100 * (s - u)) // u
    may = F.col("alike").between(F.col("alike_from") - reach, F.col("alike_to") + reach) & (F.col("n") * u >= F.col("n_from") * s) & (F.col("n") * s <= F.col("n_to") * u)
    by_pivot = half.join(outer, "p").where(F.col("outer") | may).select("sid", "id", "n", F.col("p").alias("g"), "pn", "linked", "k", "lacked", "vals", "outer")
    k = F.col("k")
    near = F.floor((k * (u + s) - (u - s) * (F.col("n") - F.col("pn"))) / (2 * (u + s))) + 1
    other = F.ceil((k * s - (u - s) * F.col("n")) / s)
    need = F.greatest(F.when(F.col("linked"), near).otherwise(other), F.lit(1))
    # values that all members lack are the last of every prefix, and one list
    by_pivot = by_pivot.withColumn("first", k - need + 1).withColumn("k", k - F.col("lacked"))
    by_all = by_pivot.where("first > k").select(F.xxhash64("g").alias("v"), "sid", "id", "n")
    away = sides.where(F.col("alike") < rule.wide).select("sid", "p", "own", "alike")
    mixed = away.groupBy("p").agg(F.min("own").alias("lo"), F.max("own").alias("hi"), F.min("alike").alias("least"))
    far = away.join(mixed.where((F.col("lo") != F.col("hi")) & (F.col("least") < HALF)), "p", "left_semi").select("sid").distinct()
    return _prefixes(by_pivot, F.col("first")).unionByName(by_all).unionByName(_prefixes(_own(whole.join(far, "sid", "left_semi")), _own_prefix(rule.share)))


def _with_sets(pairs: DataFrame, sets: DataFrame, key: str = "id") -> DataFrame:
    """Each pair with both sides' ids, values and sizes."""
    side = lambda x: sets.select(F.col(key).alias(x), F.col("id").alias(f"id{x}"), F.col("n").alias(f"n{x}"), F.col("vals").alias(f"v{x}"))
    return pairs.join(_unsent(side("a")), "a").join(_unsent(side("b")), "b")


def estimated(pairs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose union-sketch estimate is high enough: a, b, estimate."""
    least = F.slice(F.array_sort(F.array_union("va", "vb")), 1, SKETCH)
    both = F.size(F.array_intersect(least, F.array_intersect("va", "vb")))
    return _with_sets(pairs, classes).withColumn("estimate", both / F.size(least)).where(F.col("estimate") >= rule.estimate).select("a", "b", "estimate")


def _linked(pairs: DataFrame, sets: DataFrame, rule: Rule, key: str = "id") -> DataFrame:
    """The pairs that full sets confirm, as ids a and b."""
    shared = F.size(F.array_intersect("va", "vb"))
    rows = _with_sets(pairs, sets, key).withColumn("shared", shared)
    near = rows.where(F.col("shared") * rule.united >= (F.col("na") + F.col("nb") - F.col("shared")) * rule.shared)
    return near.select(F.col("ida").alias("a"), F.col("idb").alias("b")).distinct()


def _wanted_sets(slim: DataFrame, pairs: DataFrame) -> DataFrame:
    """Full sets (id, n, vals) of the documents in pairs, and of few others.

    A bit map of hashed ids says whose texts a second scan turns into sets, so no
    text is shuffled; the joins with the pairs drop the others. On very large
    inputs the map fills up and more sets are written, which changes no result.
    """
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(MAP_BITS))
    slots = pairs.select(F.explode(F.array("a", "b")).alias("id")).select(slot("id").alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS int))")).alias("bits")).collect()
    marks = np.zeros(MAP_BITS // 64, np.int64)
    for r in words:
        marks[r.word] = r.bits

    def chosen(batches):
        for batch in batches:
            at = batch.column(2).to_numpy()
            yield batch.filter(pa.array((marks[at >> 6] >> (at & 63)) & 1 == 1))

    scan = slim.where("doc_id IS NOT NULL").select("doc_id", "text", slot("doc_id").alias("slot"))
    return scan.mapInArrow(lambda b: _sets(chosen(b), None), SET_ROWS).select(F.col("doc_id").alias("id"), "n", "vals")


def _meet_the_rest(slim: DataFrame, often: DataFrame, joined: DataFrame, rule: Rule) -> DataFrame:
    """The components after every pair of the classes mostly in long lists (``often``: their posts) is linked, joined without, or excluded."""
    k = F.least("k", F.lit(INDEXED))
    vals = often.select(F.col("id").alias("sid"), "id", "n", F.lit(0).alias("g"), k.alias("k"), F.lit(True).alias("outer"), "v")
    apart = _apart(_first(_common(vals.withColumn("most", _own_prefix(rule.common / INDEXED)))).distinct(), joined)
    open_ids = materialize(apart.select("id").distinct(), "near-open")
    full = _wanted_sets(slim, open_ids.select(F.col("id").alias("a"), F.col("id").alias("b"))).join(open_ids, "id", "left_semi")
    full = materialize(full.withColumn("sid", F.xxhash64("id", "vals")).dropDuplicates(["sid"]).select("sid", "id", "n", "vals"), "near-sets")
    # a set's values that no other open set has count by n and k alone from here on
    own = _own(full).withColumn("most", _own_prefix(rule.share))
    common = materialize(_common(own.select("sid", "id", "n", "g", "k", "most", "outer", F.explode("vals").alias("v"))), "near-common")
    open_sets, values = common.agg(F.count("*"), F.coalesce(F.sum(F.size("vs")), F.lit(0))).first()
    few, most = values <= OPEN_VALUES, LIST * open_sets
    whole = common.select("sid", "id", "n", F.col("vs.v").alias("vals"))
    posts, at_hand = materialize(_first(together(common, few)), "near-lists"), together(whole, few)
    discard(open_ids, full)
    for _ in range(ROUNDS):
        apart = materialize(_apart(together(posts, few), joined), "near-apart")
        left = apart.agg(F.sum("outside")).first()[0]
        if not left:
            return joined
        if left <= most:
            return joined_further(joined, _linked(_all_across(apart, rule), whole, rule, "sid"))
        met = materialize(_against_pivots(together(apart, few), at_hand, rule), "near-pivots")
        found = _linked(_all_across(apart.where(_direct()), rule), whole, rule, "sid")
        near = met.where("linked").select(F.col("pid").alias("a"), F.col("id").alias("b"))
        old = joined, posts, apart
        joined = joined_further(joined, found.unionByName(near))
        posts = materialize(_next_lists(together(met, few), at_hand, joined, rule), "near-lists")
        discard(*(x for x in old if x is not joined), met)
    centres = ROUND
    while True:
        apart = materialize(_apart(posts, joined), "near-apart")
        outside = apart.agg(F.max("outside")).first()[0]
        if not outside:
            return joined
        place = F.row_number().over(Window.partitionBy("v").orderBy(F.xxhash64("sid"), "sid"))
        chosen = apart.where("own <> home").withColumn("place", place).where(F.col("place") <= centres)
        joined = joined_further(joined, _linked(_across(chosen, apart, rule), whole, rule, "sid"))
        if outside <= centres:
            return joined
        posts, centres = posts.join(apart.where(F.col("outside") > centres).select("v").distinct(), "v", "left_semi"), centres * GROWTH


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: tuple[int, int] = (SHARED, UNITED)) -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id (least id with an equal set), component_id, kept. Linked: Jaccard of ``similarity`` (a fraction) or more."""
    rule = Rule(*similarity)
    if not 0.75 <= rule.share <= 1:
        raise ValueError("similarity must be from 3/4 to 1")
    small_batches(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = materialize(slim.mapInArrow(lambda b: _sets(b, SKETCH), SET_ROWS), "near-sketches")
    classes = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("vals").alias("vals")
    )
    classes = materialize(classes, "near-classes")
    found, often = candidates(classes, rule)
    pairs = materialize(estimated(found, classes, rule), "near-pairs")
    sets = materialize(_wanted_sets(slim, pairs), "near-sets")
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("estimate", -F.col("a"))).alias("a")).select("a", "b")
    links = materialize(_linked(best, sets, rule), "near-links")
    first = components(links)
    label = lambda x: first.select(F.col("id").alias(x), F.col("component").alias(f"c{x}"))
    rest = pairs.join(best, ["a", "b"], "left_anti").join(label("a"), "a", "left").join(label("b"), "b", "left")
    rest = rest.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    joined = joined_further(first, _linked(rest, sets, rule))
    discard(pairs, sets, links)
    joined = _meet_the_rest(slim, often, joined, rule)
    known = classes.select("digest", "id").join(joined, "id", "left").select("digest", F.col("id").alias("class_id"), F.coalesce("component", "id").alias("component_id"))
    out = rows.select("doc_id", "n", "digest").join(known, "digest", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, similarity: tuple[int, int] = (SHARED, UNITED)) -> DataFrame:
    """The documents that stay, one of each group, all columns."""
    stay = near_duplicates(docs, similarity=similarity).where("kept").select(F.col("doc_id").alias("__near_id")).distinct()
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["__near_id"]), "left_semi")
