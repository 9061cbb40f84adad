"""Best-fit packing of token sequences: large pieces are matched in pairs, small ones best-fit the gaps.

Texts become token ids (the vocabulary's word merges) and a closing id 0; only those longer than `capacity` are cut.  Equal lengths
are interchangeable, so the plan is made on the histogram of lengths, at most `capacity` numbers however many documents there are:

1. Pieces above a third of the capacity go at most two to a sequence.  From the largest down, each is matched with the largest
   other one that still fits beside it.
2. Smaller pieces, from the longest down, go where the least room is left that holds them; then to new sequences.

The plan is a list of runs (so many pieces of a length, so many per sequence, from this sequence on), some thousands of rows at
most.  Each piece takes its place by its rank among the pieces of its length; ranks come from counts per (length, hash bucket) and
an order within a bucket, so a length that most pieces share is ranked by many tasks.

Defined cases: a null or empty text is the closing id alone; null and repeated doc_ids are packed row by row; pieces with equal
doc_id, number, length and checksum are interchangeable; an empty table gives an empty result; other columns are neither read nor
touched.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import MEMORY, Remembered, cut, table

CAPACITY = 2048
#: Pieces per bucket when ranks are counted.
BUCKET_ROWS = 200_000
VOCABULARY = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class WordTokens:
    """Ids of texts under the word vocabulary, remembered word by word.

    The vocabulary drops white space and never merges across it, so ids of a text are the ids of its words.  Texts in plain Latin
    script are put in lower case and marks are set off from letters before they are split, which leaves few different words; words
    of such texts are parted by the vocabulary's own pattern and merged by its model.  Any other word goes through the whole
    tokenizer.
    """

    #: Characters whose lower case and class no library disputes, and the vocabulary's pattern over them.
    PLAIN = re.compile(r"[!-~¡-¬®-įı-ž]+")
    UNUSUAL = re.compile(r"[^ -~\t-\r¡-¬®-įı-ž]|<\|")
    LETTERS = "a-zªµºß-öø-ÿā-ž"
    DIGITS = "0-9²³¹¼-¾"
    PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{LETTERS}{DIGITS}]+")
    #: Whole runs of marks, without an apostrophe in or beside them: parts of their own, whatever is around.
    ALL_MARKS = re.compile(rf"[^\s{LETTERS}{DIGITS}]+")
    MARKS = re.compile(rf"(?<![^\s{LETTERS}{DIGITS}])[^\s{LETTERS}{DIGITS}']++(?!')")
    ODD_SPACE = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.alphabet = {code: "".join(part for part, _ in level.pre_tokenize_str(chr(code))) for code in range(0xA1, 0x180)}
        self.words = Remembered(self.word_ids, 2 * MEMORY)

    def part_ids(self, part: str) -> bytes:
        return packed_ids([t.id for t in self.model.tokenize(part if part.isascii() else part.translate(self.alphabet))])

    def word_ids(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.part_ids(word.lower())
        if self.PLAIN.fullmatch(word) and "<|" not in word:
            return b"".join(map(self.part_ids, self.PARTS.findall(word.lower())))
        return packed_ids(self.whole.encode(word, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self.UNUSUAL.search(text):
            marks = self.MARKS if "'" in text else self.ALL_MARKS
            words = marks.sub(r" \g<0> ", text.lower()).split()
        else:
            words = re.split("[ \t-\r]+", text) if self.ODD_SPACE.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, words))


def packed_ids(ids: list) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit numbers) of every row of docs (doc_id, text)."""

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = WordTokens(path)
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = tokens.ids("" if text is None else text) + b"\0\0\0\0"
                doc_id = None if pd.isna(doc_id) else doc_id
                rows += [(doc_id, i, i * capacity, min(capacity, len(ids) // 4 - i * capacity), ids[4 * i * capacity : 4 * (i + 1) * capacity]) for i in range(-(-len(ids) // (4 * capacity)))]
                held += len(ids)
                if held > 1 << 23:
                    yield framed(rows)
                    rows, held = [], 0
            yield framed(rows)

    def framed(rows: list) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids"])
        return frame.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut_up, "doc_id long, piece int, start long, length long, ids binary")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, pieces per sequence, offset) that place all pieces of the histogram."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    groups: list[tuple[int, list[tuple[int, int]]]] = []  # sequences alike: how many, and (length, pieces) in each
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(count: int, content: list[tuple[int, int]]) -> None:
        by_gap[capacity - sum(x * k for x, k in content)].append(len(groups))
        groups.append((count, content))

    third = capacity // 3
    for large in range(capacity, third, -1):
        mate = min(large, capacity - large)
        while left[large]:
            while mate > third and not left[mate]:
                mate -= 1
            if mate <= third:
                add(int(left[large]), [(large, 1)])
                left[large] = 0
            elif mate == large:
                pairs = int(left[large]) // 2
                if pairs:
                    add(pairs, [(large, 2)])
                    left[large] -= 2 * pairs
                mate -= 1
            else:
                pairs = int(min(left[large], left[mate]))
                add(pairs, [(large, 1), (mate, 1)])
                left[large] -= pairs
                left[mate] -= pairs
    for small in range(third, 0, -1):
        gap = small
        while left[small]:
            while gap <= capacity and not by_gap[gap]:
                gap += 1
            if gap > capacity:
                each = capacity // small
                count, rest = divmod(int(left[small]), each)
                if count:
                    add(count, [(small, each)])
                if rest:
                    add(1, [(small, rest)])
                left[small] = 0
                break
            count, content = groups[at := by_gap[gap].pop()]
            groups[at] = (0, [])
            each = gap // small
            full = min(count, int(left[small]) // each)
            rest = int(left[small]) - full * each if full < count else 0
            if full:
                add(full, [*content, (small, each)])
            if rest:
                add(1, [*content, (small, rest)])
            if count - full - (rest > 0):
                add(count - full - (rest > 0), content)
            left[small] -= full * each + rest
    runs, ranks, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for count, content in groups:
        offset = 0
        for length, each in content:
            runs.append((length, int(ranks[length]), count * each, sequence, each, offset))
            ranks[length] += count * each
            offset += length * each
        sequence += count
    return runs


def ranked(pieces: DataFrame, n: int) -> DataFrame:
    """Adds `rank`, gapless from 0 among the pieces of a length."""
    keys = ["doc_id", "piece", "ids_crc32"]
    buckets = max(64, -(-n // BUCKET_ROWS))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = counts.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy(*[F.col(k).asc_nulls_first() for k in keys])) - 1
    return dealt.withColumn("inside", inside).join(before, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("inside")).drop("bucket", "inside", "before")


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 with sequence_id and offset.  pieces: those columns; read several times."""
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    runs = np.array(sorted(plan(histogram, capacity)), np.int64).reshape(-1, 6)
    scale = np.int64(max(1, sum(histogram.values())))

    def assigned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        firsts = runs[:, 0] * scale + runs[:, 1]
        for batch in batches:
            length, rank = batch["length"].to_numpy(np.int64), batch.pop("rank").to_numpy(np.int64)
            run = runs[np.searchsorted(firsts, length * scale + rank, side="right") - 1]
            nth = rank - run[:, 1]
            yield batch.assign(sequence_id=run[:, 3] + nth // run[:, 4], offset=run[:, 5] + nth % run[:, 4] * length, doc_id=batch["doc_id"].astype("Int64"))

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = ranked(pieces.select(*columns), sum(histogram.values())).select(*columns, "rank")
    return rows.mapInPandas(assigned, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def assembled(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """sequence_id and ids of every sequence; pieces with ids and their places, for tables without repeated rows."""
    parts = places.select("doc_id", "piece", "sequence_id", "offset").join(pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    content = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` parts
    return parts.groupBy("sequence_id").agg(F.aggregate(content, F.lit(b""), lambda x, p: F.concat(x, p["ids"])).alias("ids"))


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    pieces = pieces_of(docs, path or tokenizer_path(), capacity)
    return placed(cut(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))), capacity)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
