"""Token packing into sequences of several context sizes.

Documents are cut into full windows of the largest size; what is left of each is routed to the
smallest size that holds it. Sizes are packed from large to small: a window is opened by the
longest piece left, its gap filled with the longest pieces of smaller sizes that fit, and at last
with a cut, so that every window is exactly full. Rows are packed where they lie, a bounded number
of bytes at a time; nothing is shuffled. All sizes are powers of two, so they need no padding.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from barmill.llm.common import batches_of, prepare, table, trim, trimmed

#: Context sizes, all powers of two.
LARGEST, SMALLEST = 4096, 64
#: Tokens of a step, a multiple of the largest size.
STEP_TOKENS = 8 * LARGEST
#: Added to the end of each document.
END = 2
VOCABULARY = "word_bpe_49k.json"
#: Bytes of text that are packed together.
UNIT_BYTES = 6_000_000
#: Words that a task remembers, and the bytes of the longest.
REMEMBERED, REMEMBERED_BYTES = 1 << 18, 32

# Where a letter or digit is followed by neither (nor a blank), the tokenizer always cuts.
_LETTER = "a-zß-öø-ÿªµº0-9"
_CUT = f"([{_LETTER}])([^{_LETTER}\\s])"
# Texts that are taken as they are: characters beyond Latin-1, or a special token spelt out.
_OTHER = "[^\\x{00}-\\x{ff}]|<\\|"
_LOWER_CASE = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿªµº"
_LETTERS = f"^[{_LOWER_CASE}]+$"
_IDS = pa.list_(pa.uint32())


class WordTokenizer:
    """Token ids of many texts, each distinct word encoded once.

    The tokenizer never joins anything across blanks, so a text's ids are those of its words.
    Latin-1 texts are lower-cased and their words cut from the punctuation after them first, which
    it does too; that leaves fewer distinct words. Words of small letters alone, which it neither
    changes nor cuts, are cut at blanks instead of by its patterns. The short words met last are
    remembered from call to call.
    """

    def __init__(self, vocabulary: str, remembered: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.by_blanks = Tokenizer(self.tokenizer.model)
        self.by_blanks.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # Other rules than those of the vocabulary above are left to its own tokenizer.
        sample = f"{_LOWER_CASE} {_LOWER_CASE}"
        both = [t.encode(sample, add_special_tokens=False) for t in (self.tokenizer, self.by_blanks)]
        self.same = both[0].ids == both[1].ids and both[0].word_ids == both[1].word_ids
        self.remembered = remembered
        self.words, self.ids = pa.array([], pa.string()), pa.array([], _IDS)

    def _encode(self, words: list[str], letters: bool) -> pa.ListArray:
        """Ids of each of these words, which are all of letters alone or taken as any."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for lo in range(0, len(words), 250):
            some = words[lo : lo + 250]
            found = (self.by_blanks if letters else self.tokenizer).encode(" ".join(some), add_special_tokens=False)
            ids.append(np.array(found.ids, np.uint32))
            if letters:
                word = np.array(found.word_ids, np.int64)
            else:
                ends = np.cumsum([len(w) + 1 for w in some])
                word = np.searchsorted(ends, np.array([a for a, _ in found.offsets], np.int64), "right")
            sizes.append(np.bincount(word, minlength=len(some)))
        return pa.ListArray.from_arrays(np.cumsum(np.concatenate(sizes)).astype(np.int32), np.concatenate(ids))

    def _ids_of(self, words: pa.Array) -> pa.ListArray:
        """Ids of each of these distinct words, which take the place of those not met for longest."""
        known = pc.index_in(words, value_set=self.words)
        new, letters = known.is_null(), pc.and_(pc.match_substring_regex(words, _LETTERS), pa.scalar(self.same))
        others = pc.and_not(new, letters)
        letters = pc.and_(new, letters)
        coded = pa.concat_arrays(
            [
                self.ids,
                self._encode(words.filter(letters).to_pylist(), True),
                self._encode(words.filter(others).to_pylist(), False),
            ]
        )
        at = pc.fill_null(known, 0).to_numpy().astype(np.int64)
        first = len(self.words)
        for some in (letters, others):
            rows = np.flatnonzero(some.to_numpy(zero_copy_only=False))
            at[rows] = np.arange(first, first + len(rows))
            first += len(rows)
        unmet = np.ones(first, bool)
        unmet[at] = False
        unmet = pa.array(unmet[: len(self.words)])
        coded = coded.take(pa.array(at))
        short = pc.less_equal(pc.binary_length(words), REMEMBERED_BYTES)
        self.words, self.ids = (
            pa.concat_arrays([met, older.filter(unmet)[: self.remembered - len(met)]])
            for met, older in (
                (words.filter(short)[: self.remembered], self.words),
                (coded.filter(short)[: self.remembered], self.ids),
            )
        )
        return coded

    def encode(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each closed by ``end``, and how many each has."""
        column = pc.fill_null(column, "")
        plain = pc.replace_substring_regex(pc.utf8_lower(column), _CUT, r"\1 \2")
        column = pc.if_else(pc.match_substring_regex(column, _OTHER), column, plain)
        words = pc.ascii_split_whitespace(column)
        closed = np.cumsum(pc.list_value_length(words).to_numpy(), dtype=np.int64)
        coded = words.flatten().dictionary_encode()
        del column, plain, words
        distinct = pa.concat_arrays([self._ids_of(coded.dictionary), pa.array([[end]], _IDS)])
        # The end mark is one more word, after those of each text.
        codes = np.insert(coded.indices.to_numpy(), closed, len(distinct) - 1)
        begins = distinct.offsets.to_numpy()
        ends = np.cumsum(np.diff(begins)[codes], dtype=np.int64)
        flat = distinct.take(pa.array(codes)).flatten().to_numpy()
        return flat, np.diff(ends[closed + np.arange(len(closed))], prepend=0)


def pack(lengths: list[int], largest: int = LARGEST, smallest: int = SMALLEST) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that cover documents of these lengths.

    Every sequence is as long as a power of two, at most ``largest``; those under ``smallest``
    come from the last window alone. No document, no piece.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    left: list[tuple[int, int]] = []  # length and document, ascending; a rest is a document's end
    for doc, n in enumerate(lengths):
        for start in range(0, n - largest + 1, largest):
            pieces.append((doc, start, largest, sequence, 0))
            sequence += 1
        if n % largest:
            left.append((n % largest, doc))
    left.sort()
    while left:
        n, doc = left.pop()
        size = max(smallest, 1 << (n - 1).bit_length())
        window = [(doc, lengths[doc] - n, n)]
        gap = size - n
        while gap and left:
            at = bisect_right(left, (gap, len(lengths)))
            if at:
                n, doc = left.pop(at - 1)
                window.append((doc, lengths[doc] - n, n))
                gap -= n
            else:  # all that is left is longer: the shortest is cut
                n, doc = left.pop(0)
                window.append((doc, lengths[doc] - n, gap))
                insort(left, (n - gap, doc))
                gap = 0
        sequence = _close(window, size - gap, size, sequence, pieces)
    return pieces


def _close(window: list[tuple[int, int, int]], used: int, size: int, sequence: int, pieces: list) -> int:
    """Number the pieces of a window; one that is not full becomes windows of smaller powers of two."""
    while size > used:
        size //= 2
    offset = 0
    for doc, start, n in window:
        while n:
            taken = min(n, size - offset)
            pieces.append((doc, start, taken, sequence, offset))
            start, n, offset, used = start + taken, n - taken, offset + taken, used - taken
            if offset == size:
                sequence, offset = sequence + 1, 0
                while size > used > 0:
                    size //= 2
    return sequence


_PIECE = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, sequence_tokens bigint, step_group bigint"
)


def _piece_rows(vocabulary: str, with_ids: bool):
    @trimmed
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(vocabulary)
        partition = TaskContext.get().partitionId()
        for unit, some in enumerate(batches_of(batches, UNIT_BYTES)):
            some = some.combine_chunks()
            if not some.num_rows:
                continue
            ids, lengths = tokenizer.encode(some["text"].chunk(0), END)
            begins = np.cumsum(lengths) - lengths
            packed = np.array(pack(lengths.tolist()), np.int64).reshape(-1, 5)
            doc, start, length, sequence, offset = packed.T
            data = np.ascontiguousarray(ids, "<u4")
            at = begins[doc] + start
            sums = [crc32(data[a : a + n]) for a, n in zip(at.tolist(), length.tolist())]
            # Powers of two, longest first, fill steps without a rest; only the last is short.
            tokens = np.bincount(sequence, length).astype(np.int64)
            order = np.argsort(-tokens, kind="stable")
            step = np.empty(len(tokens), np.int64)
            step[order] = (np.cumsum(tokens[order]) - tokens[order]) // STEP_TOKENS
            base = (partition << 36) + (unit << 20)
            columns = {
                "doc_id": some["doc_id"].chunk(0).take(pa.array(doc)),
                "start": start,
                "length": length,
                "ids_crc32": np.array(sums, np.int64),
                "doc_tokens": lengths[doc].astype(np.int64),
                "sequence_id": base + sequence,
                "offset": offset,
                "sequence_tokens": tokens[sequence],
                "step_group": base + step[sequence],
            }
            if with_ids:
                columns["ids"] = pa.array([data[a : a + n] for a, n in zip(at, length)], pa.list_(pa.int32()))
            yield from pa.table(columns).to_batches()
            del some, ids, data, columns
            trim()

    return rows


def packed_pieces(documents: DataFrame, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece of a document in a sequence.

    ``doc_id``, ``start`` (ids of the document before the piece), ``length``, ``ids_crc32`` (of its
    ids as little-endian 32-bit words), ``doc_tokens``, ``sequence_id``, ``offset`` (in the
    sequence), ``sequence_tokens``, ``step_group`` (sequences that make up one step; all but the
    last of a unit have the same number of tokens), and ``ids`` if asked for. A null or empty text
    is the end mark alone. Repeated rows are packed each, under the same id. Other columns of
    ``documents`` are neither read nor returned.
    """
    prepare(documents.sparkSession)
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    chosen = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    schema = _PIECE + (", ids array<int>" if with_ids else "")
    return chosen.mapInArrow(_piece_rows(vocabulary, with_ids), schema)


def op8_packing(spark, sf_dir):
    return packed_pieces(table(spark, sf_dir, "documents"))
