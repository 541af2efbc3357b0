"""SentencePiece encoding and decoding over a relational lattice.

Encoding finds, for every word, the segmentation into vocabulary pieces with the highest sum of piece
scores. Words are runs of one character class with the spaces before them; no piece of a vocabulary
that ``load`` accepts crosses their borders, so words are segmented independently. Distinct words are
exploded into substrings of bounded length, equi-joined to the piece table, the edges grouped by word,
and the best path folded with ``aggregate``. Pieces that shorter ones equal or beat are on no best path
and are left out of the table. Characters without piece fall back to byte pieces.

Texts are never shuffled. A first pass replaces each text by the numbers of its words within a block
of texts and stores these numbers bucketed by block, with the block's distinct words; the lattice runs
over the distinct words of all blocks; its results are packed by block and meet the stored numbers
there. Hot words cost one row per block.

The model is a parameter: a sentencepiece file with byte pieces. Scores are taken as the file has
them, so the result is the unigram (Viterbi) segmentation, not the merge order of a BPE model. Decoding
is exact for any text: a literal word-space mark is written as bytes, and runs of more than
``MAX_SPACES`` spaces or ``MAX_WORD`` letters are segmented in parts of that length.

Defined results: a null text has null ids and decodes to null; an empty text has no ids; ties take the
shorter last piece, then the larger id; repeated rows get equal ids; an empty table gives an empty
table; extra columns are not read.
"""

import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import text_bytes, work_path

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_SPACES, MAX_WORD = 16, 48
#: Text bytes of a block: what one task holds the words of.
BLOCK_BYTES = 28 * 1024 * 1024
#: Words of a lattice task, up to ten times the shuffle partitions.
TASK_WORDS = 50_000
#: Largest vocabulary that is sent to all executors.
MAX_PIECES = 1_000_000

_FIRST = "block int, at int, word string, docs array<bigint>, payload binary"
_FIRST_SCHEMA = pa.schema([
    ("block", pa.int32()), ("at", pa.int32()), ("word", pa.string()), ("docs", pa.list_(pa.int64())),
    ("payload", pa.binary()),
])
_NULL = 0xFFFFFFFF


class Vocabulary:
    """Pieces with spaces for the word-space mark, their scores, byte pieces and the word pattern."""

    def __init__(self, pieces: list[tuple[int, str, float]], byte_ids: list[int], size: int):
        self.pieces, self.byte_ids, self.size = pieces, byte_ids, size
        self.unknown = min((s for _, _, s in pieces), default=0.0) - 10.0
        self.useful = self._useful(pieces)
        self.longest = max((len(p) for _, p, _ in self.useful), default=1)
        # characters that the vocabulary joins with the other class than their own
        own = "".join(sorted({c for _, p, _ in pieces for c in p if self._mixed(p) and not c.isascii()}))
        spaces, letters = f" {{0,{MAX_SPACES}}}", f"[^\\W\\d_{re.escape(own)}]"
        others = f"(?:[\\W\\d_{re.escape(own)}](?<![ \\n]))"
        self.pattern = (
            f"{spaces}{letters}{{1,{MAX_WORD}}}|{spaces}{others}{{1,{MAX_WORD}}}|\\n| {{1,{MAX_SPACES}}}"
        )
        whole = re.compile(f" *(?:{letters}+|{others}+)?|\\n")
        crossing = [p for _, p, _ in pieces if not whole.fullmatch(p)]
        if crossing:
            raise ValueError(f"pieces cross word borders: {crossing[:5]}")

    @staticmethod
    def _useful(pieces: list[tuple[int, str, float]]) -> list[tuple[int, str, float]]:
        """Pieces that some best path may take: those that no sequence of shorter ones equals or beats."""
        scores: dict[str, float] = {}
        useful = []
        for i, piece, own in sorted(pieces, key=lambda p: (len(p[1]), p[0])):
            best = [0.0] + [float("-inf")] * len(piece)
            for e in range(1, len(piece) + 1):
                for s in range(e):
                    score = scores.get(piece[s:e])
                    if score is not None and best[s] + score > best[e]:
                        best[e] = best[s] + score
            if best[-1] < own:
                scores[piece] = own
                useful.append((i, piece, own))
        return useful

    @staticmethod
    def _mixed(piece: str) -> bool:
        body = piece.lstrip(" ")
        return not re.fullmatch(r"[^\W\d_]*|[\W\d_]*", body)


def load(model_file: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    if size > MAX_PIECES:
        raise ValueError(f"{size} pieces are more than {MAX_PIECES}")
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
    byte_ids, pieces = [0] * 256, []
    for i in range(size):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not special[i]:
            pieces.append((i, model.id_to_piece(i).replace("▁", " "), float(model.get_score(i))))
    if 0 in byte_ids:
        raise ValueError("the model has no byte pieces")
    return Vocabulary(pieces, byte_ids, size)


class _Numbers(dict):
    """Numbers of words by first occurrence."""

    def __missing__(self, word: str) -> int:
        value = self[word] = len(self)
        return value

    def of(self, words: list[str]) -> bytes:
        return array("I", map(self.__getitem__, words)).tobytes()


def _number_words(pattern: str, limit: int):
    """Texts to word numbers within a block of texts; then the block's words."""

    def run(batches):
        import zstandard

        words, pack = re.compile(pattern), zstandard.ZstdCompressor(3)
        part, chunk, seen, numbers = TaskContext.get().partitionId(), 0, 0, _Numbers()

        def flush(block):
            # sorted words compress best on their way to the lattice
            found = sorted(numbers)
            for i in range(0, len(found), 20_000):
                some = found[i : i + 20_000]
                n, at = len(some), numbers.of(some)
                columns = [
                    pa.array(np.full(n, block, np.int32)), pa.array(np.frombuffer(at, np.int32)), pa.array(some, pa.string()),
                    pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_FIRST_SCHEMA)

        for b in batches:
            block, lens, each = part * 4096 + chunk, [], []
            for text in b.column(1).to_pylist():
                found = numbers.of(words.findall(" " + text)) if text else b""
                each.append(found)
                lens.append(_NULL if text is None else len(found) // 4)
                seen += len(text or "")
            all_numbers = np.frombuffer(b"".join(each), np.uint8).reshape(-1, 4)
            body = np.array(lens, np.uint32).tobytes() + all_numbers.T.tobytes()
            columns = [
                pa.array([block], pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string()),
                pa.array([b.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([pack.compress(body)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_FIRST_SCHEMA)
            if seen > 1.5 * limit:
                yield from flush(block)
                chunk, seen, numbers = chunk + 1, 0, _Numbers()
        yield from flush(part * 4096 + chunk)
        numbers.clear()
        pa.default_memory_pool().release_unused()

    return run


def segment(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The relational lattice: per distinct word, its ``places`` and best ``ids``."""
    spark = words.sparkSession
    table = spark.createDataFrame(vocabulary.useful, "id int, piece string, score double")
    grouped = words.groupBy("word").agg(F.collect_list("place").alias("places"))
    starts = grouped.select("word", "places", F.explode(F.expr("sequence(0, length(word) - 1)")).alias("s"))
    # the row of length 0 carries the places of a word through the join
    longest = F.expr(f"sequence(if(s = 0, 0, 1), least({vocabulary.longest}, length(word) - s))")
    spans = starts.select(
        "word", F.when(F.col("s") == 0, F.col("places")).alias("places"), "s", F.explode(longest).alias("l")
    ).select(
        "word", F.when(F.col("l") == 0, F.col("places")).alias("places"), "s", "l",
        F.expr("substring(word, s + 1, l)").alias("piece"),
    )
    edge = F.struct(
        ((F.col("s") + F.col("l")) * 256 + F.col("s")).alias("es"),
        F.coalesce("id", -F.col("s") - 1).alias("id"),
        F.coalesce("score", F.lit(vocabulary.unknown)).alias("score"),
    )
    # a character without piece is an edge of its own, numbered below 0
    joined = spans.join(F.broadcast(table), "piece", "left").where(F.col("id").isNotNull() | (F.col("l") <= 1))
    lattice = joined.groupBy("word").agg(
        F.first("places", ignorenulls=True).alias("places"),
        F.collect_list(F.when(F.col("l") > 0, edge)).alias("edges"),
    )
    score = "st[x.es & 255].score + x.score"
    longer = f"named_struct('score', {score}, 'ids', concat(st[x.es & 255].ids, array(x.id)))"
    end = "shiftright(x.es, 8)"
    # by end, then start: numbers sort far faster than structs
    in_order = (
        "transform(array_sort(transform(edges, (x, i) -> shiftleft(cast(x.es as bigint), 16) + i)),"
        " k -> edges[cast(k & 65535 as int)])"
    )
    path = F.expr(
        f"aggregate({in_order}, array(named_struct('score', 0D, 'ids', cast(array() as array<int>))), (st, x) ->"
        f" if({end} >= size(st), concat(st, array({longer})),"
        f" if({score} >= element_at(st, -1).score, concat(slice(st, 1, {end}), array({longer})), st)),"
        " st -> element_at(st, -1).ids)"
    )
    byte_ids = "array(" + ", ".join(map(str, vocabulary.byte_ids)) + ")"
    code = "hex(encode(substring(word, -i, 1), 'utf-8'))"
    in_bytes = (
        f"transform(sequence(1, length({code}), 2), k ->"
        f" element_at({byte_ids}, 1 + cast(conv(substring({code}, k, 2), 16, 10) as int)))"
    )
    spelled = F.expr(
        f"if(exists(path, i -> i < 0), flatten(transform(path, i -> if(i >= 0, array(i), {in_bytes}))), path)"
    )
    return lattice.select("word", "places", path.alias("path")).select("places", spelled.alias("ids"))


def _gather(starts: np.ndarray, lens: np.ndarray, flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``at`` of ``flat`` one after another, and their lengths."""
    n = lens[at]
    ends = np.cumsum(n)
    index = np.repeat(starts[at] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
    return flat[index], n


def _pack_by_block(batches):
    """Segmented places to one compressed piece per block and few hundred thousand places."""
    import zstandard

    pack = zstandard.ZstdCompressor(3)

    def packed(places, lens, flat):
        place, n, ids = np.concatenate(places), np.concatenate(lens), np.concatenate(flat)
        starts = np.cumsum(n) - n
        block = place >> 32
        order = np.argsort(block, kind="stable")
        names, first = np.unique(block[order], return_index=True)
        out = []
        for i, j in zip(first, np.append(first[1:], len(order)), strict=True):
            at = order[i:j]
            got, sizes = _gather(starts, n, ids, at)
            head = np.array([len(at)], np.uint32).tobytes()
            out.append(pack.compress(
                head + (place[at] & 0xFFFFFFFF).astype(np.uint32).tobytes()
                + sizes.astype(np.uint32).tobytes() + got.astype(np.uint32).tobytes()
            ))
        return pa.RecordBatch.from_arrays(
            [pa.array(names.astype(np.int32)), pa.array(out, pa.binary())], names=["block", "blob"]
        )

    places, lens, flat, held = [], [], [], 0
    for b in batches:
        ids = b.column("ids")
        places.append(b.column("place").to_numpy(zero_copy_only=False))
        lens.append(ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        flat.append(ids.flatten().to_numpy(zero_copy_only=False))
        held += len(b)
        if held >= 400_000:
            yield packed(places, lens, flat)
            places, lens, flat, held = [], [], [], 0
    if held:
        yield packed(places, lens, flat)


def _assemble(docs: pa.Table, blobs: pa.Table) -> pa.Table:
    """The ids of a block's texts from their word numbers and the block's segmented words."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    numbers, lens, flat = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
    for blob in blobs.column("blob").to_pylist():
        raw = np.frombuffer(unpack.decompress(blob), np.uint32)
        n = int(raw[0])
        numbers.append(raw[1 : 1 + n].astype(np.int64))
        lens.append(raw[1 + n : 1 + 2 * n].astype(np.int64))
        flat.append(raw[1 + 2 * n :].astype(np.int32))
    number, length, ids = np.concatenate(numbers), np.concatenate(lens), np.concatenate(flat)
    starts = np.empty(len(number), np.int64)
    starts[number] = np.cumsum(length) - length
    by_number = np.empty(len(number), np.int64)
    by_number[number] = length
    out = [pa.table({"doc_id": pa.nulls(0, pa.int64()), "ids": pa.nulls(0, pa.list_(pa.int32()))})]
    for names, payload in zip(docs.column("docs").to_pylist(), docs.column("payload").to_pylist(), strict=True):
        raw, n = unpack.decompress(payload), len(names)
        lens = np.frombuffer(raw[: 4 * n], np.uint32)
        at = np.ascontiguousarray(np.frombuffer(raw[4 * n :], np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
        null = lens == _NULL
        values, sizes = _gather(starts, by_number, ids, at.astype(np.int64))
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(np.where(null, 0, lens).astype(np.int64)))]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()), mask=pa.array(null))
        out.append(pa.table({"doc_id": pa.array(names, pa.int64()), "ids": lists}))
    return pa.concat_tables(out)


def encode(docs: DataFrame, vocabulary: Vocabulary, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row ``doc_id`` and its piece ``ids``."""
    spark = docs.sparkSession
    parts = max(1, -(-text_bytes(docs) // block_bytes))
    numbered = docs.select("doc_id", "text").coalesce(max(parts, spark.sparkContext.defaultParallelism)).mapInArrow(
        _number_words(vocabulary.pattern, block_bytes), _FIRST
    )
    name = f"pieces_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered.write.option("compression", "zstd").bucketBy(buckets, "block").option("path", work_path(spark, "word-numbers")).saveAsTable(name)
    stored = spark.table(name)
    words = stored.where(F.col("word").isNotNull()).select(
        "word", (F.shiftleft(F.col("block").cast("long"), 32) + F.col("at")).alias("place")
    )
    # many small tasks: the edges of a task's words are sorted in memory
    tasks = max(buckets, min(words.count() // TASK_WORDS, 10 * buckets))
    found = segment(words.repartition(tasks, "word"), vocabulary).select(F.explode("places").alias("place"), "ids")
    blobs = found.mapInArrow(_pack_by_block, "block int, blob binary")
    texts = stored.where(F.col("word").isNull()).select("block", "docs", "payload")
    return texts.groupBy("block").cogroup(blobs.groupBy("block")).applyInArrow(
        _assemble, "doc_id bigint, ids array<int>"
    )


def decode(docs: DataFrame, vocabulary: Vocabulary, column: str = "ids"):
    """The text of piece ids, as a column."""
    surface = [b""] * vocabulary.size
    for i, piece, _ in vocabulary.pieces:
        surface[i] = piece.encode()
    for value, i in enumerate(vocabulary.byte_ids):
        surface[i] = bytes([value])
    shared = docs.sparkSession.sparkContext.broadcast(surface)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared.value
        lens = np.array([len(s) for s in table], dtype=np.int64)
        flat = np.frombuffer(b"".join(table), np.uint8)
        starts = np.cumsum(lens) - lens
        for rows in batches:
            out = []
            for ids in rows:
                if ids is None:
                    out.append(None)
                    continue
                told = _gather(starts, lens, flat, np.asarray(ids, dtype=np.int64))[0].tobytes().decode()
                out.append(told[1:])
            yield pd.Series(out, dtype=object)

    return text(F.col(column))
