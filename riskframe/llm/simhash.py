"""SimHash near-dedup: an inverted index over byte positions with count filtering.

A fingerprint has 64 bits: bit i is set if it is set in more than half of the XXH64 hashes (seed 42) of
the text's word shingles, repeats included. Two fingerprints that differ in at most two bits agree in at
least six of their eight bytes. The index lists distinct fingerprints by what stands at their byte
positions. A single byte has 2,048 lists, whose pairs would grow with the square of the table; so a list
is named by four positions at once: the eight bytes form four pairs, and of any two fingerprints with at
most two different bytes at least two pairs agree, hence one of the six lists of two pairs holds both.
Each pair that meets in a list is met in the first such list only; its equal positional bytes are tallied,
pairs with fewer than ``8 - bits`` of them are dropped, and the rest are verified bit by bit.

Lists of more than ``DENSE`` fingerprints are not paired: a member instead names itself and every
fingerprint that differs in one of the 32 bits which the list leaves free. Two members differ in at most
two bits exactly if they name a common one, and all who name the same one are within two bits of each
other, so they are linked to the smallest of them. That is exact, linear in the list, groups at
most 33, and needs no cap. Copies share a fingerprint and are one entry from the start; only
fingerprints travel, texts are read once.

Defined results: null texts and texts without words have fingerprint zero and are linked like any other;
with fewer words than a shingle the whole sequence is one shingle; each row is a document: rows that
repeat an identifier have their own fingerprints and classes; rows without identifier take part and
never are the smallest (a class of such rows only has a null component); an empty table gives an empty
table; very long texts are hashed in slices of bounded size; extra columns are not read.
"""

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import LOWER_BYTES, stage
from riskframe.llm.components import components

WORDS = 3
BITS = 2
#: From here on naming neighbours (33 a member) makes fewer rows than pairing (half a list a member).
DENSE = 64
#: Shingles hashed at once within a text.
SLICE = 65_536

_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
#: The six lists: which two of the four 16-bit parts of a fingerprint they are named by.
_LISTS = list(itertools.combinations(range(4), 2))


def _text_fingerprint(text: str | None, words: int) -> int:
    import xxhash

    parts = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()
    if not parts:
        return 0
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    n = max(1, len(parts) - words + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(words, len(parts)) - 1 :].tolist()
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, SLICE):
        h = np.fromiter(
            (digest(joined[a:b], 42) for a, b in zip(starts[at : at + SLICE], stops[at : at + SLICE], strict=True)),
            dtype=np.uint64, count=min(SLICE, n - at),
        )
        columns = h.astype(">u8").view(np.uint8).reshape(-1, 8)  # the byte of the highest bits first
        if len(columns) < 1024:
            set_bits += np.unpackbits(columns, axis=1).sum(axis=0, dtype=np.int64)
        else:
            for k in range(8):
                set_bits[8 * k : 8 * k + 8] += np.bincount(columns[:, k], minlength=256) @ _ONES
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """The fingerprint of a text as a signed 64-bit number."""

    @F.pandas_udf("bigint")
    def hashed(texts: pd.Series) -> pd.Series:
        values = np.fromiter((_text_fingerprint(t, words) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(values.view(np.int64))

    return hashed(text)


def _part(col: str, k: int) -> Column:
    return F.shiftrightunsigned(F.col(col), 16 * k).bitwiseAND(0xFFFF)


def _list_keys(col: str) -> Column:
    """The keys of the lists that hold a fingerprint: number of the list, then its 32 bits."""
    return F.array(*(
        F.lit(k << 32).bitwiseOR(F.shiftleft(_part(col, a), 16)).bitwiseOR(_part(col, b))
        for k, (a, b) in enumerate(_LISTS)
    ))


def _equal_bytes(different: Column) -> Column:
    """How many of the eight bytes of an XOR are zero."""
    zero = [(F.shiftrightunsigned(different, 8 * k).bitwiseAND(0xFF) == 0).cast("int") for k in range(8)]
    return sum(zero[1:], zero[0])


def _first_list(different: Column) -> Column:
    """The number of the first list in which two fingerprints meet."""
    same = [F.shiftrightunsigned(different, 16 * k).bitwiseAND(0xFFFF) == 0 for k in range(4)]
    return F.coalesce(*(F.when(same[a] & same[b], k) for k, (a, b) in enumerate(_LISTS)))


def links(prints: DataFrame) -> DataFrame:
    """Links ``a`` > ``b`` that connect all distinct fingerprints (column ``p``) within two bits."""
    index = stage(prints.select("p", F.explode(_list_keys("p")).alias("key")), "simhash-index")
    sizes = stage(index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-lists")
    listed = stage(index.join(sizes, "key"), "simhash-listed")
    few = listed.where(F.col("n") <= DENSE)
    left = few.select("key", F.col("p").alias("a"))
    right = few.select("key", F.col("p").alias("b"))
    different = F.col("a").bitwiseXOR(F.col("b"))
    met = left.join(right, "key").where("a > b")
    tallied = met.where(
        (_first_list(different) == F.shiftright("key", 32)) & (_equal_bytes(different) >= 8 - BITS)
    )
    paired = tallied.where(F.bit_count(different) <= BITS).select("a", "b")

    # lists with more members: one bit of the two parts that the list leaves free
    free = F.array(*(
        F.array(*(F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for k in range(4) if k not in pair for b in range(16 * k, 16 * k + 16)))
        for pair in _LISTS
    ))
    flips = F.concat(F.array(F.lit(0).cast("long")), F.element_at(free, F.shiftright("key", 32).cast("int") + 1))
    named = listed.where(F.col("n") > DENSE).select("key", "p", F.explode(flips).alias("flip")).select(
        "key", F.col("p").bitwiseXOR(F.col("flip")).alias("name"), "p"
    )
    # everyone who names the same one is within two bits: at most 33 members, linked to the smallest
    low = named.groupBy("key", "name").agg(F.min("p").alias("b"), F.sort_array(F.collect_set("p")).alias("all"))
    dense = low.where(F.size("all") > 1).select(F.explode("all").alias("a"), "b").where("a > b")
    return paired.unionByName(dense)


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``."""
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint(F.col("text"), words).alias("p")), "simhash-rows")
    prints = stage(rows.groupBy("p").agg(F.min("doc_id").alias("low")), "simhash-prints")
    classes = components(links(prints.select("p")))
    grouped = stage(
        prints.join(classes, prints["p"] == classes["node"], "left").select(
            "p", "low", F.coalesce("component", "p").alias("component")
        ),
        "simhash-classes",
    )
    smallest = grouped.groupBy("component").agg(F.min("low").alias("component_id"))
    named = stage(grouped.join(smallest, "component").select("p", "component_id"), "simhash-components")
    return rows.join(named, "p").select(
        "doc_id", F.lower(F.lpad(F.hex("p"), 16, "0")).alias("fingerprint"), "component_id"
    )
