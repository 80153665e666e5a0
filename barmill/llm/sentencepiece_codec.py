"""SentencePiece ids and back, by a forward pass that words with a common beginning share.

A piece never crosses from a letter to the blank mark of the next word, so words (with the marks
before them) are segmented one by one, and each distinct word once. Distinct words are sorted,
which lists the trie they form depth first: a word keeps the forward states of the beginning that
it shares with the word before it and only walks on from there.

The state of a prefix is its best segmentation's last piece. For a unigram model that is the one
of the highest sum of scores. A BPE model does not maximise sums: its result is the one chain of
pieces in which every two neighbours, put together, would be merged into just these two. Chains
extend prefix by prefix in the same way, with that test in place of the score.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.common import batches_of, prepare, table, texts, trim, trimmed

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Bytes of text whose distinct words are segmented together.
UNIT_BYTES = 4_000_000
#: Words, and pairs of pieces, that a Python worker remembers.
MOST_WORDS, MOST_PAIRS = 300_000, 400_000


class Pieces:
    """The vocabulary of a model file; ``kind`` is "bpe" or "unigram"."""

    def __init__(self, path: str, kind: str = "bpe"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kind = kind
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.raw: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.raw.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i):
                self.raw.append(b"")
            elif model.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.score[piece] = model.get_score(i)
                self.raw.append(piece.replace(MARK, " ").encode())
        self.unknown = model.unk_id()
        self.longest = max(map(len, self.ids))
        self.least_score = min(self.score.values(), default=0.0)
        self.word = self._word_pattern()
        self._finder = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self._finder.add_word(piece, (len(piece), i, self.score[piece]))
        self._finder.make_automaton()
        # Words met lately, and those met before them.
        self._words: dict[str, tuple[int, ...]] = {}
        self._older: dict[str, tuple[int, ...]] = {}
        self._pairs: dict[int, bool] = {}

    def _word_pattern(self) -> re.Pattern:
        """Words with the marks before them, cut further where no piece can cross: between a letter
        and punctuation that no piece holds next to a letter, and around line ends."""
        together = {pair for piece in self.ids for pair in zip(piece, piece[1:])}
        together |= {(b, a) for a, b in together}
        near_letters = {a for a, b in together if b.isalpha()}
        line = "" if any("\n" in pair for pair in together) else "\n"
        signs = set(string.punctuation) - near_letters
        others = {b for a, b in together if a in signs and b.isalnum()}
        letter = r"[^\W\d_" + re.escape("".join(sorted(others))) + "]"
        sign = "[" + re.escape("".join(sorted(signs))) + "]" if signs else r"[^\s\S]"
        word = f"{letter}+(?={sign}|[{MARK}{line}]|\\Z)|{sign}+(?={letter}|[{MARK}{line}]|\\Z)|[^{MARK}{line}]+"
        return re.compile(f"{MARK}*(?:{word})|{MARK}+" + (f"|{line}" if line else ""))

    def merged(self, text: str) -> list[str]:
        """Byte-pair merges by score, the leftmost first among equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stays(self, before: str, piece: str) -> bool:
        """Whether two neighbouring pieces come out of the merges as they are."""
        return self.merged(before + piece) == ([before, piece] if before else [piece])

    def _walk(self, word: str, shared: int, last: list, total: list[float]) -> None:
        """States of the prefixes longer than ``shared``: the length and id of the last piece.

        A prefix that no piece ends is closed by an unknown character, which nothing merges with.
        """
        bpe, pairs, unknown = self.kind == "bpe", self._pairs, (1, -1)

        def close(upto: int) -> None:
            while len(last) <= upto:
                total.append(total[-1] + self.least_score - 10)
                last.append(unknown)

        for end, (n, i, score) in self._finder.iter(word, max(0, shared + 1 - self.longest)):
            end += 1
            if end <= shared:
                continue
            if len(last) < end:
                close(end - 1)
            known = len(last) > end
            if bpe:
                if known:
                    continue
                before = last[end - n][1]
                key = (before + 1 << 20) + i
                stays = pairs.get(key)
                if stays is None:
                    start = end - n
                    text = word[start - last[start][0] : start] if before >= 0 else ""
                    if len(pairs) >= MOST_PAIRS:
                        pairs.clear()
                    stays = pairs[key] = self._stays(text, word[start:end])
                if stays:
                    last.append((n, i))
                    total.append(0.0)
            elif not known:
                last.append((n, i))
                total.append(total[end - n] + score)
            elif total[end - n] + score > total[end]:
                last[end], total[end] = (n, i), total[end - n] + score
        close(len(word))

    def _read(self, word: str, last: list) -> tuple[int, ...]:
        """Ids from the states of a word's prefixes, back from its end."""
        out: list[int] = []
        end = len(word)
        while end:
            n, i = last[end]
            if i >= 0:
                out.append(i)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in reversed(word[end - 1 : end].encode("utf-8", "surrogatepass")))
            else:
                out.append(self.unknown)
            end -= n
        return tuple(reversed(out))

    def segment(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct words, walking the trie that they form depth first."""
        found = {}
        last, total, previous = [(0, -1)], [0.0], ""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(previous))
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            del last[shared + 1 :], total[shared + 1 :]
            self._walk(word, shared, last, total)
            found[word] = self._read(word, last)
            previous = word
        return found

    def words(self, text: str) -> list[str]:
        return self.word.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, column: list[str]) -> list[np.ndarray]:
        split = [self.words(t) for t in column]
        known, older, new = self._words, self._older, []
        for word in set(chain.from_iterable(split)):
            if word not in known:
                if word in older:
                    known[word] = older[word]
                else:
                    new.append(word)
        known.update(self.segment(new))
        ids = [np.fromiter(chain.from_iterable(map(known.__getitem__, s)), np.int32) for s in split]
        if len(known) > MOST_WORDS // 2:
            self._words, self._older = {}, known
        return ids

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; bytes that are no UTF-8 become U+FFFD, the mark before the text goes."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


_loaded: dict[tuple[str, str], Pieces] = {}


def pieces_of(path: str, kind: str) -> Pieces:
    """The vocabulary, read once by a Python worker."""
    if (path, kind) not in _loaded:
        _loaded[path, kind] = Pieces(path, kind)
    return _loaded[path, kind]


def _encode_rows(path: str, kind: str):
    @trimmed
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path, kind)
        for some in batches_of(batches, UNIT_BYTES):
            for part in [some.combine_chunks()] if some.num_rows else []:
                ids = pa.array(pieces.encode(texts(part["text"])), pa.list_(pa.int32()))
                out = pa.table({"doc_id": part["doc_id"], "text": part["text"], "ids": ids})
                yield from out.to_batches(max_chunksize=500)
                del part, ids, out
                trim()

    return rows


def _decode_rows(path: str, kind: str):
    @trimmed
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path, kind)
        for batch in batches:
            ids = batch["ids"]
            flat, ends = ids.flatten().to_numpy(), np.cumsum(ids.value_lengths().fill_null(0).to_numpy())
            parts = [flat[lo:hi] for lo, hi in zip(np.r_[0, ends[:-1]], ends)] if len(ends) else []
            others = [batch[n] for n in batch.schema.names if n != "ids"]
            names = [n for n in batch.schema.names if n != "ids"]
            sums = pa.array([crc32(p.astype("<u4")) for p in parts], pa.int64())
            counts = pa.array([len(p) for p in parts], pa.int64())
            decoded = pa.array([pieces.decode(p) for p in parts], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*others, counts, sums, decoded], [*names, "n_tokens", "ids_crc32", "decoded"]
            )

    return rows


def encode(documents: DataFrame, model: str | None = None, kind: str = "bpe") -> DataFrame:
    """``doc_id``, ``text`` and ``ids`` of every row.

    A null or empty text has no ids. A very long one is encoded whole, in a unit of its own. Characters that the vocabulary lacks become byte pieces.
    Repeated rows are encoded each. Other columns are neither read nor returned.
    """
    prepare(documents.sparkSession)
    path = model or public_tokenizers.path(MODEL)
    chosen = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return chosen.mapInArrow(_encode_rows(path, kind), "doc_id bigint, text string, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None, kind: str = "bpe") -> DataFrame:
    """``n_tokens``, ``ids_crc32`` and ``decoded`` in place of ``ids``; all other columns stay.

    The mark character U+2581 in a text comes back as a blank, as in the library.
    """
    prepare(encoded.sparkSession)
    path = model or public_tokenizers.path(MODEL)
    schema = encoded.drop("ids").schema.add("n_tokens", "long").add("ids_crc32", "long").add("decoded", "string")
    return encoded.mapInArrow(_decode_rows(path, kind), schema)


def op3_sentencepiece(spark, sf_dir):
    decoded = decode(encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id",
        "n_tokens",
        "ids_crc32",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )
