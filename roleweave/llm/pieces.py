"""Operator 4, SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is cut into marked words: each run of blanks stays with the run of letters or of other characters behind it, as
far as no piece of the vocabulary spans such a cut. The distinct marked words of a slice are sorted, which lays them out as a trie in depth-first order, and each word keeps the forward
column of its predecessor up to their common prefix: only the rest of the word is computed. A place of the column holds
the best score and the last piece over all pieces that end there.

For a unigram vocabulary every piece may follow every other, and the best score wins. A byte-pair vocabulary ranks
merges by score instead of adding scores, so a plain Viterbi over its scores gives other pieces than the model; here a
piece may follow another only if merging their joined text gives back just the two. Exactly one piece per place then
remains, and the path is the one that merging the whole word gives. Both run through the same traversal.

Text needs no pass outside its own task: no shuffle, memory follows a slice and a bounded word table. Pieces are
Python tuples for the distinct words only; whole texts are joined from them.

Null encodes to null, the empty text to no pieces. A character no piece holds becomes its UTF-8 bytes. A literal U+2581
decodes to a blank, as in the model. Repeated rows are encoded alike; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roleweave.llm import arrays

MARK = "▁"
# Words of one generation, and piece pairs, that a task remembers.
REMEMBERED = 200_000


@dataclass
class Vocabulary:
    """What encoding needs of a model: pieces with id and score, ids of the 256 bytes, and how scores count."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    byte_pair: bool = True
    pieces: dict[int, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.pieces = {i: piece for piece, i in self.ids.items()}
        ends: dict[str, set[int]] = {}
        for piece in self.ids:
            if len(piece) > 2:
                ends.setdefault(piece[-3:], set()).add(len(piece))
        # Lengths of the longer pieces that end with the same three characters, longest first, and the short lengths.
        self.lengths = {end: (*sorted(lengths, reverse=True), 2, 1) for end, lengths in ends.items()}
        self.words = self._cuts()

    def _cuts(self) -> str:
        """Pattern of the marked words: no piece is longer than one match."""
        mixed, pattern = "", f"{MARK}+[^{MARK}]*|[^{MARK}]+"
        for _ in range(3):
            letter, other = f"[^\\W\\d_{mixed}]", f"(?:[^\\w{MARK}]|[\\d_{mixed}])"
            finer = f"{MARK}*{letter}+|{MARK}*{other}+|{MARK}+"
            spanning = [p for p in self.ids if not re.fullmatch(finer, p)]
            if not spanning:
                return finer
            # Letters of pieces that mix both count as other characters.
            mixed += re.escape("".join(sorted({c for p in spanning for c in p if re.match(letter, c)})))
            if len(mixed) > 200:
                break
        return pattern

    def ids_of(self, piece: str) -> tuple[int, ...]:
        return (self.ids[piece],) if piece in self.ids else tuple(self.byte_ids[b] for b in piece.encode("utf-8", "replace"))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str | None = None, byte_pair: bool = True) -> Vocabulary:
    """Read a SentencePiece model file; `byte_pair` says whether its scores rank merges or are log-probabilities."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path or default_model())
    plain = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    ids = {model.id_to_piece(i): i for i in plain}
    return Vocabulary(ids, {p: model.get_score(i) for p, i in ids.items()}, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], byte_pair)


class Encoder:
    """Encodes sorted words, keeping the forward column of the last one."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.word, self.score, self.last = "", [0.0], [""]
        self.stands: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging, best score first, leftmost on ties."""
        parts, scores = list(text), self.vocabulary.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, before: str, piece: str) -> bool:
        """Whether `piece` may stand behind `before` (empty at the start of a word)."""
        if not self.vocabulary.byte_pair:
            return True
        known = self.stands.get((before, piece))
        if known is None:
            if len(self.stands) >= REMEMBERED:
                self.stands.clear()
            known = self.merged(before + piece) == ([before, piece] if before else [piece])
            self.stands[before, piece] = known
        return known

    def pieces(self, word: str) -> list[str]:
        """The best path through `word`; cheap if `word` shares a long prefix with the word before it."""
        shared, most = 0, min(len(word), len(self.word))
        while shared < most and word[shared] == self.word[shared]:
            shared += 1
        score, last = self.score, self.last
        del score[shared + 1 :], last[shared + 1 :]
        scores, lengths, first_wins = self.vocabulary.scores, self.vocabulary.lengths, self.vocabulary.byte_pair
        stands = self.stands
        for end in range(shared + 1, len(word) + 1):
            best, chosen = -1e300, word[end - 1]
            for length in lengths.get(word[end - 3 : end], (2, 1)) if end > 2 else (2, 1)[2 - end :]:
                start = end - length
                if start < 0:
                    continue
                piece = word[start:end]
                own = scores.get(piece)
                if own is None:
                    if length > 1:
                        continue
                    own = -1e12  # a character without a piece of its own is written as bytes
                before = last[start]
                allowed = stands.get((before, piece))
                if allowed is None:
                    allowed = self.may_follow(before, piece)
                if allowed and score[start] + own > best:
                    best, chosen = score[start] + own, piece
                    if first_wins:
                        break
            score.append(best)
            last.append(chosen)
        self.word = word
        out, place = [], len(word)
        while place:
            out.append(last[place])
            place -= len(last[place])
        return out[::-1]


class WordTable:
    """Ids of marked words, filled slice by slice in trie order."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.encoder, self.known = vocabulary, Encoder(vocabulary), {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.words = re.compile(vocabulary.words)

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        cut = [None if t is None else self.words.findall((MARK + t).replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        new = set(chain.from_iterable(x for x in cut if x)).difference(self.known)
        # Words of the generation before move on; those not met since are forgotten with it.
        met = new.intersection(self.older)
        self.known.update(zip(met, map(self.older.__getitem__, met)))
        ids_of = self.vocabulary.ids_of
        for word in sorted(new.difference(met)):
            self.known[word] = tuple(chain.from_iterable(map(ids_of, self.encoder.pieces(word))))
        known = self.known.__getitem__
        return [None if x is None else np.fromiter(chain.from_iterable(map(known, x)), dtype=np.int32) for x in cut]


class Decoder:
    """Text of piece ids; runs of byte pieces become characters, or U+FFFD where they aren't UTF-8."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        bytes_of = {i: bytes([b]) for b, i in enumerate(vocabulary.byte_ids)}
        size = max([*vocabulary.pieces, *bytes_of], default=-1) + 1
        self.table = [bytes_of.get(i, vocabulary.pieces.get(i, "").replace(MARK, " ").encode()) for i in range(size)]

    def text(self, ids: np.ndarray) -> str:
        whole = b"".join(map(self.table.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return whole[1:] if whole.startswith(" ") else whole


def _digests(ids: np.ndarray | None) -> tuple[int | None, str | None]:
    return (None, None) if ids is None else (len(ids), hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest())


def encoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """All columns of `docs` and `piece_ids`, replacing a column of that name."""
    kept = [c for c in docs.columns if c != "piece_ids"]
    model = arrays.shared(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(model())
        for batch in arrays.slices(batches, "text"):
            found = table.encode(batch.column("text").to_pylist())
            ids = pa.array(found, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [ids], [*kept, "piece_ids"])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    return docs.mapInArrow(run, ", ".join([*fields, "piece_ids array<int>"]))


def decoded(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """All columns of `rows` and `decoded`, the text of `piece_ids`; null ids give null."""
    kept = [c for c in rows.columns if c != "decoded"]
    model = arrays.shared(rows.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model())
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts = [None if x is None else decoder.text(np.array(x, dtype=np.int32)) for x in part.column("piece_ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(texts, pa.string())], [*kept, "decoded"])

    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept]
    return rows.mapInArrow(run, ", ".join([*fields, "decoded string"]))


def tokenized(docs: DataFrame, vocabulary: Vocabulary, names: tuple[str, str, str] = ("piece_ids", "n_pieces", "round_trip")) -> DataFrame:
    """All columns of `docs`, then the ids, how many they are, and whether decoding gives the text back, under these names.

    Encoding and decoding share a pass, so one Python worker holds what both need. A null text has nulls in all three.
    """
    kept = docs.columns
    model = arrays.shared(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, decoder = WordTable(model()), Decoder(model())
        for batch in arrays.slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            found = table.encode(texts)
            sizes = [None if x is None else len(x) for x in found]
            same = [None if x is None else decoder.text(x) == t for x, t in zip(found, texts)]
            new = [pa.array(found, pa.list_(pa.int32())), pa.array(sizes, pa.int32()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + new, [*kept, *names])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept]
    return docs.mapInArrow(run, ", ".join([*fields, f"`{names[0]}` array<int>", f"`{names[1]}` int", f"`{names[2]}` boolean"]))


def round_trips(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_pieces, ids_sha256 (of the little-endian 32-bit ids), n_decoded (characters) and whether decoding gives
    the text back. Encoding and decoding happen in one pass, so that ids don't travel."""
    model = arrays.shared(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = model()
        table, decoder = WordTable(vocabulary), Decoder(vocabulary)
        for batch in arrays.slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            found = table.encode(texts)
            back = [None if x is None else decoder.text(x) for x in found]
            digests = [_digests(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for n, _ in digests], pa.int64()),
                    pa.array([h for _, h in digests], pa.string()),
                    pa.array([None if x is None else len(x) for x in back], pa.int64()),
                    pa.array([None if x is None else x == t for x, t in zip(back, texts)], pa.bool_()),
                ],
                ["doc_id", "n_pieces", "ids_sha256", "n_decoded", "round_trip"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, ids_sha256 string, n_decoded long, round_trip boolean")
