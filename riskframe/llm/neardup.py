"""MinHash near-dedup by a chosen-path set similarity join.

Texts become sets of word shingles (64-bit hashes); equal sets form a class at once, and the work
below is on classes. Independent trees branch the classes recursively: a node draws one signature
position, and a second one with probability ``SECOND``, and sends each class to the child named by
its minwise token there, so that a similar pair has more than one common child in expectation at
every level. Nodes of at most ``SMALL`` classes are compared exhaustively, larger ones branch on. Those
that are still larger after ``LEVELS`` levels (copies of one another throughout) compare all classes
with ``PIVOTS`` of them; the links found so far are confirmed and joined to components, and of these
nodes only those go on that hold several components. There the classes outside of the node's largest
component are compared with all classes of other components, at once where they are at most
``OUTSIDE``, after branching on otherwise, and after ``DEEPER`` further levels in any case: no node is left
uncompared, and a group of copies that its centre links costs no further pairs. Pairs must agree in
size and in a 128-bit sketch of their signatures. Before any full set travels, a sketch of the parities of
``PARITY`` buckets of a set's elements is compared: two of them differ in no more bits than the sets differ in
elements, so a pair that differs in more than the threshold allows is dropped without loss. The rest is
confirmed on the full sets. Pairs that two trees find are confirmed once. Two levels are branched at a time, so a signature is dealt out once per two levels and
not at all for the first two.

Defined results: null, empty and wordless texts have an empty set, link with nothing and are kept;
with fewer words than a shingle the whole sequence is the only element; repeated rows are copies;
rows without identifier link with nothing, are kept, and have no component; an empty table gives an
empty table; extra columns pass through.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import LOWER_BYTES, WordHash, fresh, mix64, rolling, stage
from riskframe.llm.components import components

WORDS, PERCENT = 5, 80
SIGNATURE = 128
TREES, LEVELS, SECOND = 8, 4, 0.15
SMALL, PIVOTS = 12, 2
#: Classes outside of a node's largest component that all its classes are compared with at once: pairs grow with the rows.
OUTSIDE, DEEPER = 2048, 4
FEW_CLASSES = 100_000
#: Largest difference of two 128-bit sketches; pairs at the threshold differ in far fewer bits.
SLACK_SIGMAS = 5.0

#: Buckets of the parity sketch. For sets so long that most of them are hit, a bound of as many deviations is closer.
PARITY, PARITY_SIGMAS = 512, 6.0
_ODD = [f"o{i}" for i in range(PARITY // 64)]

_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, (2, SIGNATURE), dtype=np.uint64)
_SET = "size long, hi long, lo long, signature binary, s0 long, s1 long, " + ", ".join(f"{c} long" for c in _ODD)


def shingles(text: str | None, words: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    tokens = (text or "").encode().translate(LOWER_BYTES).split()
    h = hashes.of(tokens)
    return np.unique(rolling(h, min(words, len(h)))) if len(h) else h


def signature(elements: np.ndarray) -> np.ndarray:
    """The smallest hash under each of ``SIGNATURE`` multiply-shift permutations."""
    low = np.full(SIGNATURE, np.iinfo(np.uint32).max, dtype=np.uint32)
    odd, add = _SEEDS[0] | np.uint64(1), _SEEDS[1]
    for i in range(0, len(elements), 2048):
        part = elements[i : i + 2048]
        h = ((part[:, None] * odd[None, :] + add[None, :]) >> np.uint64(32)).astype(np.uint32)
        np.minimum(low, h.min(axis=0), out=low)
    return low


def parities(elements: np.ndarray) -> list[int]:
    """Whether the number of elements is odd, per bucket, as whole numbers of 64 bits."""
    odd = np.bincount((mix64(elements) % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.frombuffer(np.packbits(odd.astype(bool)).tobytes(), np.int64).tolist()


def _described(words: int):
    @F.pandas_udf(_SET)
    def described(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash

        hashes = WordHash()
        for texts in batches:
            rows = []
            for t in texts:
                e = shingles(t, words, hashes)
                if not len(e):
                    rows.append((0, 0, 0, None, 0, 0, *[0] * len(_ODD)))
                    continue
                d, sig = xxhash.xxh3_128_digest(e.tobytes()), signature(e)
                hi, lo = np.frombuffer(d, np.int64).tolist()
                bits = np.packbits((mix64(sig.astype(np.uint64)) & np.uint64(1)).astype(bool))
                s0, s1 = np.frombuffer(bits.tobytes(), np.int64).tolist()
                rows.append((len(e), hi, lo, sig.tobytes(), s0, s1, *parities(e)))
            yield pd.DataFrame(rows, columns=["size", "hi", "lo", "signature", "s0", "s1", *_ODD])

    return described


def _sets(words: int):
    @F.pandas_udf("binary")
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = WordHash()
        for texts in batches:
            yield pd.Series([shingles(t, words, hashes).tobytes() for t in texts], dtype=object)

    return sets


def _branch(tree: np.ndarray, level: np.ndarray, path: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two children of classes below nodes, by minwise tokens the node draws, and whether both count."""
    node = mix64(path ^ mix64(tree * np.uint64(1000) + level + np.uint64(1)))
    row = np.arange(len(node))
    out = []
    for j in range(2):
        draw = mix64(node + np.uint64(j + 1))
        at = (draw % np.uint64(SIGNATURE)).astype(np.int64)
        out.append(mix64(node ^ mix64(sig[row, at].astype(np.uint64) + (draw & np.uint64(127)) * np.uint64(1 << 32))))
    two = (mix64(node + np.uint64(9)) % np.uint64(1000) < np.uint64(int(SECOND * 1000))) & (out[0] != out[1])
    return out[0], out[1], two


@F.pandas_udf(T.ArrayType(T.ArrayType(T.LongType())))
def _two_levels(tree: pd.Series, level: pd.Series, path: pd.Series, signatures: pd.Series) -> pd.Series:
    """Per child of a class below a node: the child, and its own one or two children."""
    t, lev = tree.to_numpy(np.uint64), level.to_numpy(np.uint64)
    sig = np.frombuffer(b"".join(signatures), np.uint32).reshape(-1, SIGNATURE)
    first, second, two = _branch(t, lev, path.to_numpy(np.int64).view(np.uint64), sig)

    def listed(child: np.ndarray, which: np.ndarray) -> list[list[int]]:
        a, b, both = _branch(t[which], lev[which] + np.uint64(1), child, sig[which])
        rows = zip(child.view(np.int64).tolist(), a.view(np.int64).tolist(), b.view(np.int64).tolist(), both, strict=True)
        return [[c, x, y] if w else [c, x] for c, x, y, w in rows]

    out = [[x] for x in listed(first, np.arange(len(t)))]
    also = np.flatnonzero(two)
    for i, x in zip(also.tolist(), listed(second[also], also), strict=True):
        out[i].append(x)
    return pd.Series(out, dtype=object)


@F.pandas_udf(T.BooleanType())
def _similar(percent: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for p, x, y in zip(percent, a, b, strict=True):
        u, v = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        short, long = (u, v) if len(u) <= len(v) else (v, u)
        at = np.minimum(np.searchsorted(long, short), len(long) - 1)
        common = int((long[at] == short).sum())
        out.append(100 * common >= p * (len(u) + len(v) - common))
    return pd.Series(out, dtype=bool)


def max_bits(percent: int) -> int:
    """Bits in which two sketches of a pair at the threshold may differ."""
    p = (1 - percent / 100) / 2
    return int(SIGNATURE * p + SLACK_SIGMAS * (SIGNATURE * p * (1 - p)) ** 0.5) + 1


def _alike(percent: int):
    """Whether two classes of a node are worth a full comparison."""
    return (
        (F.col("l.rep") != F.col("r.rep"))
        & (100 * F.least("l.size", "r.size") >= percent * F.greatest("l.size", "r.size"))
        & (
            F.bit_count(F.col("l.s0").bitwiseXOR(F.col("r.s0")))
            + F.bit_count(F.col("l.s1").bitwiseXOR(F.col("r.s1")))
            <= max_bits(percent)
        )
    )


def _parities_allow(percent: int) -> Column:
    """Whether two sets may be similar, by the bits in which their parities differ."""
    differ = sum((F.bit_count(F.col(f"l.{c}").bitwiseXOR(F.col(f"r.{c}"))) for c in _ODD), F.lit(0))
    most = (F.col("l.size") + F.col("r.size")) * ((100 - percent) / (100 + percent))  # elements of one set only
    likely = PARITY / 2 * (1 - F.exp(most * (-2 / PARITY))) + PARITY_SIGMAS * PARITY**0.5 / 2
    return differ <= F.least(most + 1e-6, likely)


def _pairs(left: DataFrame, right: DataFrame, percent: int, ordered: bool, apart: bool = False) -> DataFrame:
    how = _alike(percent) & (F.col("l.path") == F.col("r.path"))
    if apart:
        how = how & (F.col("l.comp") != F.col("r.comp")) & _parities_allow(percent)
    if ordered:
        how = how & (F.col("l.rep") < F.col("r.rep"))
    return left.alias("l").join(right.alias("r"), how).select(
        F.least("l.rep", "r.rep").alias("a"), F.greatest("l.rep", "r.rep").alias("b")
    )


_NODE = ["path", "rep", "size", "s0", "s1"]


def _pivots(nodes: DataFrame) -> DataFrame:
    """The class nearest to the bitwise majority of each node's sketches, and drawn ones.

    Edited copies differ from their original less than from one another, so the original of a group is
    the class nearest to the majority.
    """
    bits = [(c, i) for c in ("s0", "s1") for i in range(64)]
    counts = nodes.groupBy("path").agg(
        F.count("*").alias("m"),
        *[F.sum(F.expr(f"shiftrightunsigned({c}, {i}) & 1L")).alias(f"{c}_{i}") for c, i in bits],
    )
    major = {
        c: " | ".join(f"if(2 * {c}_{i} > m, shiftleft(1L, {i}), 0L)" for i in range(64)) for c in ("s0", "s1")
    }
    centres = counts.select("path", F.expr(major["s0"]).alias("c0"), F.expr(major["s1"]).alias("c1"))
    far = F.bit_count(F.col("s0").bitwiseXOR(F.col("c0"))) + F.bit_count(F.col("s1").bitwiseXOR(F.col("c1")))
    one = F.struct("rep", "size", "s0", "s1")
    drawn = [F.min_by(one, F.struct(F.xxhash64("rep", F.lit(i)), "rep")) for i in range(1, PIVOTS)]
    chosen = nodes.join(centres, "path").groupBy("path").agg(
        F.array(F.min_by(one, F.struct(far, "rep")), *drawn).alias("p")
    )
    return chosen.select("path", F.explode(F.array_distinct("p")).alias("p")).select("path", "p.*")


def _branched(large: DataFrame, level: int) -> DataFrame:
    """The rows of ``large`` in the children of their nodes at an odd level, the next one's in ``below``."""
    x = F.explode(_two_levels(F.col("tree"), F.lit(level), F.col("path"), F.col("signature")))
    rows = large.withColumn("x", x).withColumns({"path": F.col("x")[0], "below": F.slice("x", 2, 2)})
    return stage(rows.drop("x", "signature"), f"near-level-{level}")


def _below(large: DataFrame) -> DataFrame:
    """The rows of ``large`` in the children of their nodes at an even level."""
    return large.withColumn("path", F.explode("below")).drop("below")


def candidate_pairs(classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of classes (``rep``, ``size``, ``s0``, ``s1``, ``signature``) that some tree compares.

    Second, the rows of the nodes that are still large after the last level.
    """
    signatures = classes.select("rep", "signature")
    trees = F.explode(F.sequence(F.lit(1), F.lit(TREES)))
    roots = classes.select(trees.alias("tree"), F.lit(0).cast("long").alias("path"), "rep", "size", "s0", "s1", "signature")
    found, large, compared = [], roots, None
    for level in range(1, LEVELS + 1):
        if level % 2 == 0:
            nodes = _below(large)
        else:
            nodes = _branched(large if level == 1 else large.join(signatures, "rep"), level)
        counts = nodes.groupBy("path").agg(F.count("*").alias("n")).where("n > 1")
        sized = stage(nodes.join(counts, "path"), f"near-nodes-{level}")
        small = sized.where(F.col("n") <= SMALL).select(*_NODE)
        compared = small if compared is None else compared.union(small)
        large = sized.where(F.col("n") > SMALL).drop("n")
        if large.isEmpty():
            break
    else:
        found.append(_pairs(large.select(*_NODE), _pivots(large.select(*_NODE)), percent, ordered=False))
    # a path is a hash of its tree and level too: the nodes of all levels are compared in one join
    out = _pairs(compared, compared, percent, ordered=True)
    for more in found:
        out = out.union(more)
    return out.distinct(), large.select("tree", *_NODE)


def pairs_outside(dense: DataFrame, classes: DataFrame, known: DataFrame, percent: int) -> DataFrame | None:
    """Pairs that the large nodes have left: classes outside of a node's largest component, with all others.

    ``known`` has the components (``node``, ``component``) of the links so far; pairs within one are not needed.
    """
    if dense.isEmpty():
        return None
    signatures, odd = classes.select("rep", "signature"), classes.select("rep", *_ODD)
    nodes = dense.join(known.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep")).drop("component")
    found = []
    for level in range(LEVELS + 1, LEVELS + DEEPER + 2):
        shares = nodes.groupBy("path", "comp").agg(F.count("*").alias("m")).groupBy("path").agg(
            F.max_by("comp", F.struct("m", "comp")).alias("main"), (F.sum("m") - F.max("m")).alias("outside")
        ).where("outside > 0")
        mixed = stage(nodes.join(shares, "path"), f"near-mixed-{level}")
        if mixed.isEmpty():
            break
        few = F.lit(level > LEVELS + DEEPER) | (F.col("outside") <= OUTSIDE)
        now = mixed.where(few).select(*_NODE, "comp", "main").join(odd, "rep")
        rest = now.where(F.col("comp") != F.col("main"))
        found.append(_pairs(now, rest, percent, ordered=False, apart=True))
        large = mixed.where(~few).drop("main", "outside")
        if large.isEmpty():
            break
        # LEVELS is even, so odd levels branch and even ones follow what was branched
        if level % 2 == 0:
            nodes = _below(large)
        else:
            nodes = _branched(large.drop("below").join(signatures, "rep"), level)
    out = None
    for more in found:
        out = more if out is None else out.union(more)
    return out if out is None else out.distinct()


def _allowed(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that the parities of their sets allow."""
    held = classes.select("rep", "size", *_ODD)
    left = pairs.join(held.select("rep", F.struct("size", *_ODD).alias("l")).hint("merge"), F.col("a") == F.col("rep")).drop("rep")
    both = left.join(held.select("rep", F.struct("size", *_ODD).alias("r")).hint("merge"), F.col("b") == F.col("rep"))
    return both.where(_parities_allow(percent)).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """The pairs whose full sets (``rep``, ``elements``) are similar."""
    full_a = sets.select(F.col("rep").alias("a"), F.col("elements").alias("x"))
    full_b = sets.select(F.col("rep").alias("b"), F.col("elements").alias("y"))
    checked = pairs.join(full_a.hint("merge"), "a").join(full_b.hint("merge"), "b")
    return stage(checked.where(_similar(F.lit(percent), F.col("x"), F.col("y"))).select("a", "b"), name)


def _full_sets(docs: DataFrame, pairs: DataFrame, words: int, name: str) -> DataFrame:
    """The full sets of the classes in ``pairs``; a few classes are broadcast, so that the texts stay where they are."""
    needed = stage(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct(), f"{name}-needed")
    needed = F.broadcast(needed) if needed.count() <= FEW_CLASSES else needed.hint("shuffle_hash")
    sets = docs.join(needed, F.col("doc_id") == F.col("rep"), "left_semi").select(
        F.col("doc_id").alias("rep"), _sets(words)(F.col("text")).alias("elements")
    )
    return stage(sets.dropDuplicates(["rep"]), name)


def linked(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The described rows (``doc_id``, set size and digest) and the components (``node``, ``component``) of linked classes.

    A class is named by its smallest document. Pairs of large nodes that other links already connect may stay unconfirmed.
    """
    described = docs.select("doc_id", _described(words)(F.col("text")).alias("s")).select("doc_id", "s.*")
    described = stage(described, "near-sets")
    classes = stage(
        described.where(F.col("size") > 0).groupBy("hi", "lo", "size").agg(
            F.min("doc_id").alias("rep"),
            F.first("signature").alias("signature"),
            F.first("s0").alias("s0"),
            F.first("s1").alias("s1"),
            *[F.first(c).alias(c) for c in _ODD],
        ).where(F.col("rep").isNotNull()),
        "near-classes",
    )
    pairs, dense = candidate_pairs(classes, percent)
    pairs = stage(_allowed(pairs, classes, percent), "near-pairs")
    confirmed = _confirmed(pairs, _full_sets(docs, pairs, words, "near-full"), percent, "near-links")
    known = components(confirmed, stored=True)
    more = pairs_outside(dense, classes, known, percent)
    if more is not None:
        more = stage(more.join(pairs, ["a", "b"], "left_anti"), "near-pairs-outside")
        if not more.isEmpty():
            sets = _full_sets(docs, more, words, "near-full-outside")
            added = _confirmed(more, sets, percent, "near-links-outside")
            if not added.isEmpty():
                # the components so far are stars around their smallest class: few edges, and mostly settled
                stars = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
                known = components(stars.union(added), stored=True)
    return described.select("doc_id", "size", "hi", "lo"), known


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` (the smallest one is kept)."""
    described, known = linked(docs, words, percent)
    smallest = described.where((F.col("size") > 0) & F.col("doc_id").isNotNull()).groupBy("hi", "lo", "size").agg(
        F.min("doc_id").alias("rep")
    )
    joined = smallest.join(known, F.col("rep") == F.col("node"), "left").select(
        "hi", "lo", "size", F.coalesce("component", "rep").alias("found")
    )
    out = described.join(joined, ["hi", "lo", "size"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return out.select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its component, one row each."""
    found = near_duplicates(docs.select("doc_id", "text"), words, percent)
    name = fresh(docs, "_gone")
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(name))
    left = docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")
    named = left.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"])
    return named.unionByName(left.where(F.col("doc_id").isNull()))
