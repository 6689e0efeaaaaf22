"""Byte-level BPE by longest matches and backtracking, exact and linear in the length of a piece.

Bytes become Latin-1 characters, so an Aho-Corasick automaton of the vocabulary gives the longest
token that starts at each place.  A piece is tiled from the left with longest tokens; when two
adjacent tokens cannot stand side by side in the output of the merges, or nothing continues, the
last token gives way to its next shorter prefix token.  Whether two tokens may be adjacent is
decided by merging their bytes and is memoised; places known to lead nowhere are not visited
again.  The tiling whose neighbours are all compatible is the one that the merges produce.

Null texts are empty; every document keeps its row; repeated rows get equal results; of the
other columns those named in ``carry`` are kept.  A piece of any length is
encoded whole.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

# what a worker remembers is bounded: the first so many words that come again, pieces and pairs of tokens, and no long ones;
# workers of other operators keep it, as Spark hands the same processes on
LONGEST_KEPT, WORDS_KEPT, PIECES_KEPT, PAIRS_KEPT = 48, 200_000, 50_000, 250_000
SEEN_BITS = 21  # a mark per hash of a word tells that it came before
BATCH_BYTES = 8 << 20


def load_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes to rank from the text of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line)}


def merged(piece: bytes, ranks: dict[bytes, int], whole: bool = True) -> list[int]:
    """Tokens of a few bytes by the merges themselves, lowest rank first; without the last merge unless ``whole``."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    ahead = [ranks.get(parts[i] + parts[i + 1], NEVER) for i in range(len(parts) - 1)]
    while len(ahead) > (not whole) and (best := min(ahead)) < NEVER:
        i = ahead.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del ahead[i]
        if i < len(ahead):
            ahead[i] = ranks.get(parts[i] + parts[i + 1], NEVER)
        if i:
            ahead[i - 1] = ranks.get(parts[i - 1] + parts[i], NEVER)
    return [ranks[p] for p in parts]


NEVER = 1 << 62


class Encoder(dict):
    """Piece of text to its packed ids; remembers short pieces up to a bound."""

    def __init__(self, lines: bytes, pattern: str):
        super().__init__()
        self.ranks = load_ranks(lines)
        self.bytes_of = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.pattern = regex.compile(pattern)
        # tokens spelled backwards: run over a reversed piece, the automaton reports them where they start
        self.starts = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in self.ranks.items():
            self.starts.add_word(token[::-1].decode("latin-1"), rank)
        self.starts.make_automaton()
        self.words = Words(self)
        self.shorter: dict[int, int] = {}
        self.adjacent: dict[int, bool] = {}
        self.parts: dict[int, tuple[int, int]] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = array("I", self.encode_piece(piece.encode())).tobytes()
        if len(piece) <= LONGEST_KEPT and len(self) < PIECES_KEPT:
            self[piece] = packed
        return packed

    def prefix(self, token: int) -> int:
        """The longest proper prefix of a token that is a token; -1 if there is none."""
        found = self.shorter.get(token)
        if found is None:
            own = self.bytes_of[token]
            found = self.shorter[token] = next((r for k in range(len(own) - 1, 0, -1) if (r := self.ranks.get(own[:k])) is not None), -1)
        return found

    def halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge gives this one; (-1, -1) for a single byte, (-2, -2) if the merges never give it."""
        found = self.parts.get(token)
        if found is None:
            own = self.bytes_of[token]
            last = merged(own, self.ranks, whole=False)
            found = self.parts[token] = (-1, -1) if len(own) == 1 else (last[0], last[1]) if len(last) == 2 else (-2, -2)
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave exactly these two tokens where their bytes stand side by side.

        Undoes the later of the merges next to the border again and again; the border falls if a
        merge across it comes before the merge undone last.
        """
        key = left << 32 | right
        known = self.adjacent.get(key)
        if known is None:
            if len(self.adjacent) >= PAIRS_KEPT:
                self.adjacent.clear()
            known = self.adjacent[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        ranks, spelled, halves = self.ranks, self.bytes_of, self.halves
        inner, outer, limit = halves(left), halves(right), NEVER
        if inner[0] == -2 or outer[0] == -2:
            return False
        while True:
            across = ranks.get(spelled[left] + spelled[right])
            if across is not None and across < limit:
                return False
            if inner[0] < 0 and outer[0] < 0:
                return True
            if outer[0] < 0 or inner[0] >= 0 and left > right:
                limit, left = left, inner[1]  # of equal merges the left one comes first
                inner = halves(left)
            else:
                limit, right = right + 1, outer[0]
                outer = halves(right)

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [-1] * n
        spelled, compatible, last = self.bytes_of, self.compatible, n - 1
        for end, rank in self.starts.iter(piece[::-1].decode("latin-1")):
            if longest[last - end] < 0:  # the matches at one place come longest first
                longest[last - end] = rank
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while at < n:
            if token < 0:  # nothing fits here: no tiling has a border at this place
                dead[at] = 1
                token = out.pop()
                at -= len(spelled[token])
                token = self.prefix(token)
                continue
            end = at + len(spelled[token])
            if not dead[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < n else -1
            else:
                token = self.prefix(token)
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        The pattern never joins a space to what stands before it unless that is white space at
        the end or another space; else the text is taken word by word, which finds most words known.
        """
        if "  " in text or text.endswith(" "):
            return b"".join(map(self.__getitem__, self.pattern.findall(text)))
        first, *rest = text.split(" ")
        return b"".join(map(self.__getitem__, self.pattern.findall(first))) + b"".join(map(self.words.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, array("I", ids)))


class Words(dict):
    """What follows a space, up to the next one, to the packed ids of both."""

    def __init__(self, pieces: Encoder):
        super().__init__()
        self.pieces = pieces
        self.seen = bytearray(1 << SEEN_BITS)

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            packed = array("I", self.pieces.encode_piece(b" " + word.encode())).tobytes()
        else:
            first, *rest = self.pieces.pattern.findall(" " + word)
            packed = (self[first[1:]] if first[1:].isalpha() else self.pieces[first]) + b"".join(map(self.pieces.__getitem__, rest))
        if len(word) <= LONGEST_KEPT and len(self) < WORDS_KEPT:
            place = hash(word) & (1 << SEEN_BITS) - 1
            if self.seen[place]:
                self[word] = packed
            else:
                self.seen[place] = 1
        return packed


@lru_cache(maxsize=2)
def encoder(lines: bytes, pattern: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(lines, pattern)


def encode_documents(docs: DataFrame, *carry: str, vocabulary: str, pattern: str) -> DataFrame:
    """``carry``, the packed ids and the bytes decoded from them, for every document.

    ``vocabulary`` names a rank file of fixed size, read once and broadcast.
    """
    with open(vocabulary, "rb") as file:
        lines = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(lines.value, pattern)
        for batch in batches:
            start, ids, decoded, held = 0, [], [], 0
            for i, text in enumerate(batch.column("text"), 1):
                ids.append(own.encode(text.as_py() or ""))
                decoded.append(own.decode(ids[-1]))
                held += len(ids[-1])
                if held >= BATCH_BYTES or i == batch.num_rows:
                    kept = [batch.column(c).slice(start, i - start) for c in carry]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], names=[*carry, "ids", "decoded"])
                    start, ids, decoded, held = i, [], [], 0

    schema = StructType([*[docs.schema[c] for c in carry], StructField("ids", BinaryType()), StructField("decoded", BinaryType())])
    return docs.select(*carry, "text").mapInArrow(run, schema)
