"""Byte-level BPE by prefix dynamic programming.

Every prefix of a piece has exactly one valid last token: a token that ends there, whose start is
the end of a valid prefix, and that the merges would leave beside that prefix's own last token. The
table of these tokens *is* the encoding of every prefix at once. So bytes can be appended without a
look at earlier ones, and after an edit only the entries near it are computed again: as soon as one
longest token's worth of entries agrees with the old table, the rest of the old table holds.

Texts are split by the tokenizer's pattern first, each match on its own. A match that is itself a
token is that token. Ids equal those of the tiktoken library without special tokens.

Defined results: a null text counts as empty and has no tokens; an empty table gives no rows; rows
with equal ids are encoded each; other columns are not read. No row is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from keyweave.llm.corpus import table, worker_store
from keyweave.llm.registry import query

#: Entries that a worker keeps of pieces and stems, and of token pairs; a full cache is emptied.
CACHE_ENTRIES = 300_000
PAIR_ENTRIES = 1_000_000
#: Pieces up to STEM_BYTES share the tables of their beginnings, kept at every STEM_STEP bytes.
STEM_BYTES, STEM_STEP = 64, 4


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """Encoder and decoder for one rank file and its split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        #: Tokens that merges can make; any other only ever stands for a whole piece.
        self.sound: dict[bytes, int] = {}
        #: The two tokens whose merge makes a token.
        self.halves: dict[int, tuple[int, int]] = {}
        for b, i in ranks.items():
            parts = self.merged(b, stop=2)
            if len(parts) < 3:
                self.sound[b] = i
            if len(parts) == 2:
                self.halves[i] = (ranks[parts[0]], ranks[parts[1]])
        self.longest = max(map(len, self.sound), default=1)
        #: Lengths of the tokens that end with three bytes, longest first, then the shorter ones.
        self.lengths: dict[bytes, list[int]] = {}
        for b in self.sound:
            if len(b) > 2:
                self.lengths.setdefault(b[-3:], []).append(len(b))
        self.lengths = {k: [*sorted(set(v), reverse=True), 2, 1] for k, v in self.lengths.items()}
        self.pattern = regex.compile(pattern)
        self.pairs: dict[int, bool] = {}
        self.stems: dict[bytes, list[int]] = {}
        self._pieces: dict[str, bytes] = {}

    def merged(self, data: bytes, stop: int = 1) -> list[bytes]:
        """Plain merging, lowest rank first, until ``stop`` parts are left; only used to take tokens apart."""
        parts, rank, none = [data[i : i + 1] for i in range(len(data))], self.ranks.get, 1 << 62
        scores = [rank(data[i : i + 2], none) for i in range(len(data) - 1)]
        while len(scores) >= stop:
            best = min(scores)
            if best == none:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(scores):
                scores[at] = rank(parts[at] + parts[at + 1], none)
        return parts

    def side_by_side(self, left: int, right: int) -> bool:
        """True if merging the two tokens' bytes gives just these tokens; kept in ``pairs``.

        Merges run in order of rank, the leftmost first among equals. Going back in time, the tokens
        at the border are taken apart, the later one first; a merge across the border must not come
        before the one just undone.
        """
        if len(self.pairs) >= PAIR_ENTRIES:
            self.pairs.clear()
        key, rank, bytes_of, before = left << 32 | right, self.ranks.get, self.bytes_of, 1 << 62
        while True:
            across = rank(bytes_of[left] + bytes_of[right])
            if across is not None and across < before:
                fits = False
                break
            later_left = left > right
            halves = self.halves.get(left if later_left else right)
            if halves is None:
                fits = True
                break
            if later_left:
                before, left = left, halves[1]
            else:
                before, right = right + 1, halves[0]
        self.pairs[key] = fits
        return fits

    def piece_ids(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self.read(piece, self.table(piece) if len(piece) <= STEM_BYTES else PrefixTable(self, piece).last)

    def table(self, data: bytes) -> list[int]:
        """A short piece's table, appended to that of its stem; stems are kept, as words share beginnings."""
        cut = (len(data) - 1) // STEM_STEP * STEM_STEP
        if cut < STEM_STEP:
            last = [-1]
        else:
            stem = data[:cut]
            last = self.stems.get(stem)
            if last is None:
                if len(self.stems) >= CACHE_ENTRIES:
                    self.stems.clear()
                last = self.stems[stem] = self.table(stem)
            last = last.copy()
        self.extend(data, last)
        return last

    def extend(self, data: bytes, last: list[int], old: list[int] | None = None, shift: int = 0, after: int = 0) -> int:
        """Entries up to the end; stops where ``old`` (moved by ``shift``) holds again beyond ``after``.

        Returns how many entries were computed.
        """
        start, same, longest = len(last), 0, self.longest
        lengths_at, token_at, known, check = self.lengths.get, self.sound.get, self.pairs.get, self.side_by_side
        for end in range(start, len(data) + 1):
            found = -1
            for length in lengths_at(data[end - 3 : end] if end > 2 else b"", (2, 1)):
                begin = end - length
                if begin < 0:
                    continue
                token = token_at(data[begin:end])
                if token is None:
                    continue
                if not begin:
                    found = token
                    break
                left = last[begin]
                if left < 0:
                    continue
                fits = known(left << 32 | token)
                if check(left, token) if fits is None else fits:
                    found = token
                    break
            last.append(found)
            if old is not None and end > after:
                same = same + 1 if old[end - shift] == found else 0
                if same >= longest:
                    last.extend(old[end - shift + 1 :])
                    return end + 1 - start
        return max(0, len(data) + 1 - start)

    def read(self, data: bytes, last: list[int]) -> list[int]:
        """The encoding, read from the end of a table to its start."""
        out, end = [], len(data)
        while end:
            token = last[end]
            out.append(token)
            end -= len(self.bytes_of[token])
        return out[::-1]

    def encode(self, text: str | None) -> array:
        """Ids of a text as unsigned 32-bit integers."""
        out = array("I")
        out.frombytes(b"".join(map(self._packed, self.pattern.findall(text or ""))))
        return out

    def _packed(self, piece: str) -> bytes:
        found = self._pieces.get(piece)
        if found is None:
            if len(self._pieces) >= CACHE_ENTRIES:
                self._pieces.clear()
            found = array("I", self.piece_ids(piece.encode())).tobytes()
            if len(piece) <= 64:
                self._pieces[piece] = found
        return found

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixTable:
    """The last token of every prefix of one piece, kept exact under appends and edits."""

    def __init__(self, codec: Codec, data: bytes = b""):
        self.codec = codec
        self.data = bytearray()
        self.last: list[int] = [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.codec.extend(bytes(self.data), self.last)

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` in place of bytes ``start:end``; returns how many entries were computed."""
        old, shift = self.last, len(data) - (end - start)
        self.data[start:end] = data
        self.last = old[: start + 1]
        return self.codec.extend(bytes(self.data), self.last, old, shift, start + len(data))

    def ids(self) -> list[int]:
        return self.codec.read(bytes(self.data), self.last)


def task_codec(packed: bytes, pattern: str) -> Codec:
    """One codec per worker process and rank file."""
    key, store = ("codec", hash(packed), pattern), worker_store("bpe")
    if key not in store:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in packed.splitlines() if x.strip())}
        store[key] = Codec(ranks, pattern)
    return store[key]


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) and decoded bytes' sha256, one row per document.

    The rank file is read on the driver and sent as a broadcast: its size is fixed by the vocabulary.
    """
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = task_codec(ranks.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids, decoded = [], []
                for text in part.column(1):
                    found = codec.encode(text.as_py())
                    ids.append(found.tobytes())
                    decoded.append(hashlib.sha256(codec.decode(found)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded_sha256"],
                )

    return docs.select("doc_id", "text").mapInArrow(encoded, "doc_id long, ids binary, decoded_sha256 string")


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    done = round_trip(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return done.selectExpr(
        "doc_id",
        "cast(octet_length(ids) div 4 as long) AS n_tokens",
        "sha2(ids, 256) AS ids_sha256",
        "decoded_sha256",
    )
