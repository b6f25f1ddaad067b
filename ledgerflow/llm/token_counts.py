"""Token counts of whole texts, as lengths only.

Texts are encoded in Arrow batches inside the tasks. Batches handed to the encoder hold about the same number of
bytes, and a long text is split at boundaries that no token crosses, so that memory stays bounded and the count
stays exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Characters next to which a text may be cut, if the model knows them and leaves them as they are: none of them joins
#: a neighbour when text is normalised.
PLAIN = ((0x21, 0x7E), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3))


@dataclass
class Boundaries:
    """Where a model's texts may be cut: between plain characters that stand side by side in none of its pieces."""

    plain: frozenset[str]
    joined: frozenset[tuple[str, str]]
    at_spaces: bool

    def next(self, text: str, at: int) -> int:
        """The first safe cut from `at` on, or -1: in front of a character, or of the one space between two."""
        plain, joined = self.plain, self.joined
        for i in range(max(1, at), len(text) - 1):
            if text[i - 1] not in plain:
                continue
            if text[i] == " ":
                if self.at_spaces and text[i + 1] in plain and (text[i - 1], SPACE) not in joined:
                    return i
            elif text[i] in plain and (text[i - 1], text[i]) not in joined:
                return i
        return -1


@lru_cache(maxsize=4)
def _sentencepiece(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    start = model.normalize("a")[:-1]
    plain = frozenset(p for p in pieces if len(p) == 1 and any(a <= ord(p) <= b for a, b in PLAIN) and model.normalize(p) == start + p)
    # A space may be left out at a cut if the model itself puts one before each text.
    at_spaces = model.encode("a b") == model.encode("a") + model.encode("b")
    return model, Boundaries(plain, frozenset(pair for p in pieces for pair in zip(p, p[1:], strict=False)), at_spaces)


@lru_cache(maxsize=4)
def _tokenizers(path: str):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return model


def split_text(text: str, most: int, boundaries: Boundaries) -> list[tuple[str, str]]:
    """Pieces of about `most` characters, each with the character that was put before it and doesn't count.

    At a cut between words the space is left out, as the model puts one before each piece; elsewhere the character
    before the cut is repeated, so that the piece begins as the text does there. A stretch without a safe cut stays
    whole."""
    pieces, start, before = [], 0, ""
    while len(text) - start > most and (at := boundaries.next(text, start + most)) > 0:
        pieces.append((before + text[start:at], before))
        space = text[at] == " "
        start, before = at + space, "" if space else text[at - 1]
    return [*pieces, (before + text[start:], before)]


def _lengths(path: str, texts: list[str]) -> list[int]:
    if path.endswith(".model"):
        return [len(x) for x in _sentencepiece(path)[0].encode(texts, num_threads=1)]
    return [len(x.ids) for x in _tokenizers(path).encode_batch(texts, add_special_tokens=False)]


def count_batch(texts: list[str], path: str, batch_bytes: int, split_chars: int) -> list[int]:
    """Tokens of each text."""
    boundaries = _sentencepiece(path)[1] if path.endswith(".model") else None
    repeated: dict[str, int] = {}
    counts, part, owners, held = [0] * len(texts), [], [], 0

    def flush() -> None:
        for i, n in zip(owners, _lengths(path, part) if part else [], strict=True):
            counts[i] += n
        part.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for piece, before in split_text(text, split_chars, boundaries) if boundaries and len(text) > split_chars else [(text, "")]:
            part.append(piece)
            owners.append(i)
            held += len(piece.encode())
            if before:
                if before not in repeated:
                    (repeated[before],) = _lengths(path, [before])
                counts[i] -= repeated[before]
            if held >= batch_bytes:
                flush()
                held = 0
    flush()
    return counts


def token_counts(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096, batch_bytes: int = 1 << 20, split_chars: int = 1 << 15
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit for every row of docs.

    vocabulary: a sentencepiece .model or a tokenizers .json file, present on every machine. Begin, end and added
    special tokens are not counted; special strings in a text are treated as the library does by default. Null and
    empty texts count 0. Rows are neither merged nor reordered: repeated rows and null ids come back as they are, and
    other columns are ignored. A json vocabulary encodes each text whole, as its file may
    hold any rule for cutting up texts. An empty table gives an empty result."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.binary_length(batch.column(1)).cast(pa.int64()), pa.array(count_batch(texts, vocabulary, batch_bytes, split_chars), pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    out = rows.mapInArrow(count, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
