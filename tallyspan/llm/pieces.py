"""SentencePiece encoding and decoding for merge-type vocabularies, checked against the sentencepiece library.

Encoding keeps an agenda of adjacent symbol pairs ordered by the score of the
piece they would form, leftmost first among equals; the best pair merges, its
new neighbours enter the agenda, until no adjacent pair forms a piece. Symbols
that are no piece become byte pieces.

A text is first cut where no piece can span: before a run of blanks, and around
characters that stand in no piece. The vocabulary is asked where that holds.
Ids of such chunks are kept per task in a bounded table, so the agenda runs once
for each new part of a chunk. Per Arrow batch the library encodes these new
parts and decodes the ids of every whole text; a difference fails the job. With
``check="texts"`` it encodes every whole text too, which costs as much again.

Defined cases: a null text is an empty one and has no ids; lone surrogates do
not occur in Spark strings; repeated rows are encoded alike; an empty table
gives no row. Extra columns are ignored. The vocabulary file is a parameter.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tallyspan.llm.common import in_batches, slices, utf8

SPACE = "▁"
NORMAL, USER_DEFINED, BYTE, UNUSED = 1, 4, 6, 5
#: Chunks that a task remembers.
REMEMBERED = 600_000
#: Longer chunks are not remembered.
LONG = 64
#: Up to this length a scan of the agenda beats a heap.
SHORT = 40
NONE = float("-inf")


class Vocabulary:
    """A merge-type model: pieces, scores and what its normaliser does."""

    def __init__(self, model: bytes):
        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        if spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or spec.treat_whitespace_as_suffix:
            raise ValueError("a merge-type vocabulary with identity normalisation is asked for")
        if any(p.type in (USER_DEFINED, UNUSED) for p in proto.pieces):
            raise ValueError("vocabularies with user-defined or unused pieces are not supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self.bytes = [0] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
        self.unknown = spec.unk_id
        self.byte_fallback = spec.byte_fallback
        self.pieces = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.cut = self._cuts()
        self.known: dict[str, tuple[int, ...]] = {}
        self.fresh: dict[str, tuple[int, ...]] = {}  # what the agenda made since the last check

    def _cuts(self) -> re.Pattern:
        """Chunks that no piece spans: blanks and what follows them up to the next blank, and control marks alone."""
        self.joined = {a + b for piece in self.scores for a, b in itertools.pairwise(piece)}
        if any(pair[1] == SPACE != pair[0] for pair in self.joined):
            return re.compile("(?s).+")
        alone = "".join(c for c in "\n\r\t" if c not in self.scores and not any(c in pair for pair in self.joined))
        chunk = f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"
        return re.compile(f"[{alone}]|{chunk}" if alone else chunk)

    def parts(self, chunk: str) -> list[str]:
        """The chunk, cut between neighbours that stand side by side in no piece."""
        joined, out, start = self.joined, [], 0
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in joined:
                out.append(chunk[start:i])
                start = i
        out.append(chunk[start:])
        return out

    # --- agenda ---

    def merge(self, chunk: str) -> list[str]:
        """The pieces of one chunk. Short ones have their agenda as a list in place order, long ones as a heap."""
        if len(chunk) > SHORT:
            return self.merge_long(chunk)
        score, none = self.scores.get, NONE
        symbols = list(chunk)
        agenda = [score(a + b, none) for a, b in itertools.pairwise(symbols)]
        while agenda and (best := max(agenda)) != none:
            i = agenda.index(best)  # the leftmost
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = score(symbols[i] + symbols[i + 1], none)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + symbols[i], none)
        return symbols

    def merge_long(self, chunk: str) -> list[str]:
        scores = self.scores
        symbols: list[str | None] = list(chunk)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            score = scores.get(chunk[i : i + 2])
            if score is not None:
                agenda.append((-score, i, chunk[i : i + 2]))
        heapq.heapify(agenda)
        while agenda:
            _, i, piece = heapq.heappop(agenda)
            left = symbols[i]
            j = after[i]
            if left is None or j >= n or len(left) + len(symbols[j]) != len(piece) or left + symbols[j] != piece:
                continue  # one of the pair has been merged meanwhile
            symbols[i], symbols[j] = piece, None
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                score = scores.get(both := piece + symbols[j])
                if score is not None:
                    heapq.heappush(agenda, (-score, i, both))
            k = before[i]
            if k >= 0:
                score = scores.get(both := symbols[k] + piece)
                if score is not None:
                    heapq.heappush(agenda, (-score, k, both))
        return [s for s in symbols if s is not None]

    def chunk_ids(self, chunk: str) -> tuple[int, ...]:
        """Ids of one chunk; its parts are looked up before the agenda runs on them."""
        parts = self.parts(chunk)
        if len(parts) == 1:
            return self.part_ids(chunk)
        out: list[int] = []
        for part in parts:
            ids = self.known.get(part)
            if ids is None:
                ids = self.part_ids(part)
                if len(part) <= LONG:
                    self.known[part] = ids
            out.extend(ids)
        return tuple(out)

    def part_ids(self, chunk: str) -> tuple[int, ...]:
        out: list[int] = []
        for piece in self.merge(chunk):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_fallback:
                out.extend(self.bytes[b] for b in utf8(piece))
            else:
                out.append(self.unknown)
        self.fresh[chunk] = made = tuple(out)
        return made

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        chunks = self.cut.findall(self.prefix + text.replace(" ", SPACE))
        known = self.known
        found = list(map(known.get, chunks))
        if None in found:
            if len(known) > REMEMBERED:
                known.clear()
            for k, ids in enumerate(found):
                if ids is None:
                    chunk = chunks[k]
                    ids = known.get(chunk)
                    if ids is None:
                        ids = self.chunk_ids(chunk)
                        if len(chunk) <= LONG:
                            known[chunk] = ids
                    found[k] = ids
        return list(itertools.chain.from_iterable(found))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces are joined and decoded (wrong bytes become U+FFFD), the leading blank goes."""
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if self.types[i] == BYTE:
                run.append(int(self.pieces[i][1:-1], 16))
                continue
            if run:
                out.append(_bytes_text(bytes(run)))
                run.clear()
            if self.types[i] == NORMAL:
                out.append(self.pieces[i])
            elif i == self.unknown:
                out.append(" ⁇ ")
        if run:
            out.append(_bytes_text(bytes(run)))
        text = "".join(out)
        return (text.removeprefix(SPACE) if self.prefix else text).replace(SPACE, " ")


def _bytes_text(run: bytes) -> str:
    """UTF-8, each byte that is no part of a character as one U+FFFD."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(run):
            for width in (1, 2, 3, 4):
                try:
                    out.append(run[i : i + width].decode())
                    i += width
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


@functools.cache
def vocabulary(model: str) -> Vocabulary:
    with open(model, "rb") as file:
        return Vocabulary(file.read())


@functools.cache
def library(model: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model)


def check_parts(own: Vocabulary, judge: sentencepiece.SentencePieceProcessor) -> None:
    """Compares the parts that the agenda has made since the last call with the library.

    A mark that stands in no piece goes before each part, so that the library's
    prefix falls on the mark.
    """
    parts = list(own.fresh)
    lead = judge.encode("\n")
    for part, said in zip(parts, judge.encode(["\n" + p.replace(SPACE, " ") for p in parts], num_threads=1), strict=True):
        if said != lead + list(own.fresh[part]):
            raise ValueError(f"the agenda and the library differ on {part!r}")
    own.fresh.clear()


def encode_texts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", check: str = "parts") -> DataFrame:
    """doc_id, ids, decoded: every whole text encoded by the agenda and decoded again.

    model: a path of the vocabulary on every executor. check: ``parts`` or
    ``texts``, what the library encodes to compare; it decodes all ids either way.
    """
    if check not in ("parts", "texts"):
        raise ValueError(f"check is {check!r}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, judge = vocabulary(model), library(model)
        for batch in slices(batches, 256):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = list(map(own.encode, texts))
            decoded = list(map(own.decode, ids))
            check_parts(own, judge)
            if judge.decode(ids, num_threads=1) != decoded:
                raise ValueError("the library decodes other texts")
            if check == "texts" and judge.encode(texts, num_threads=1) != ids:
                raise ValueError("the agenda and the library differ on a text")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return in_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body")), run, "doc_id long, ids array<int>, decoded string")


def encoded_digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encode_texts(docs, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
