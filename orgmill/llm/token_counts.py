"""Token counts of whole documents, with huge documents encoded in overlapping chunks.

A chunk's tokens near its ends may differ from those of the whole text. So neighbouring chunks overlap, both are
encoded with offsets, and they are spliced at a boundary that both show and that is proven stable: between a
character that isn't a space and a space, for a vocabulary without any piece that holds a space after another
character (checked once when the file is loaded). Where the overlap has no such boundary it is doubled, and the
chunks grow with it, up to the whole rest of the text. The sum therefore equals the library's count of the text.

A null text counts as empty; an empty table gives no rows; repeated rows are counted one by one; a null doc_id
stays null.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from orgmill.llm.common import slices, texts

CHUNK_CHARS, OVERLAP_CHARS = 32_768, 256
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks int"

_counters: dict[str, "Counter"] = {}


def counter(path: str) -> "Counter":
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


class Counter:
    """Counts and offsets by one library: sentencepiece for .model, tokenizers for .json."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            self.piece = sentencepiece.SentencePieceProcessor(model_file=path)
            pieces, space = (self.piece.id_to_piece(i) for i in range(self.piece.get_piece_size())), "▁"
        else:
            from tokenizers import Tokenizer

            self.piece, self.tokenizer = None, Tokenizer.from_file(path)
            pieces, space = self.tokenizer.get_vocab(), "Ġ"
        self.proven = not any(space in p.lstrip(space) for p in pieces)

    def counts(self, values: list[str]) -> list[int]:
        if self.piece:
            return [len(x) for x in self.piece.encode(values, num_threads=1)]
        return [len(x) for x in self.tokenizer.encode_batch_fast(values, add_special_tokens=False)]

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token."""
        if self.piece:
            found = [(p.begin, p.end) for p in self.piece.encode(text, return_type="proto").pieces]  # in bytes
            before = np.concatenate([[0], np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)])
            both = before[np.array(found, np.int64).reshape(-1, 2)]
            return both[:, 0], both[:, 1]
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).offsets
        both = np.array(found, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]


def boundaries(text: str, start: int, end: int, low: int, spans: tuple[np.ndarray, np.ndarray]) -> set[int]:
    """Stable places in text[low:end] that no token of the chunk text[start:end] spans."""
    places = {i for i in range(max(low, start + 1), end) if text[i] == " " and not text[i - 1].isspace()}
    crossed = {i for a, b in zip(*spans) for i in range(int(a) + start + 1, int(b) + start) if i >= low}
    return places - crossed


def spliced(text: str, by: Counter, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> tuple[int, int]:
    """Tokens of text and chunks encoded for them."""
    total, chunks, at = 0, 1, 0  # text[:at] is counted; the current chunk is text[start:end]
    start, end = 0, min(chunk, len(text))
    spans = by.spans(text[start:end])
    width = overlap
    while end < len(text):
        low = max(end - width, at)
        further = min(low + max(chunk, 2 * width), len(text))
        after = by.spans(text[low:further])
        chunks += 1
        common = boundaries(text, start, end, low, spans) & boundaries(text, low, end, low, after) if by.proven else set()
        if common:
            place = max(common)
            firsts = spans[0] + start
            total += int(((firsts >= at) & (firsts < place)).sum())
            at, start, end, spans, width = place, low, further, after, overlap
        elif low > at:
            width *= 2
        else:  # not even the whole chunk has one: it grows
            width *= 2
            end = min(at + 2 * (end - at), len(text)) if by.proven else len(text)
            spans = by.spans(text[start:end])
            chunks += 1
    return total + int((spans[0] + start >= at).sum()), chunks


def count_tokens(df: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and n_chunks for each row of df. No shuffle: one pass over the texts."""

    def count(batches):
        by = counter(path)
        for batch in batches:
            for part in slices(batch):
                values = [x or "" for x in part.column("text").to_pylist()]
                long = [i for i, x in enumerate(values) if len(x) > chunk]
                found = by.counts([x if len(x) <= chunk else "" for x in values])
                parts = [1] * len(values)
                for i in long:
                    found[i], parts[i] = spliced(values[i], by, chunk, overlap)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(x.encode()) for x in values], pa.int64()), pa.array(found, pa.int64()), pa.array([n > limit for n in found]), pa.array(parts, pa.int32())], names=["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks"])

    return texts(df, id_col, text_col).mapInArrow(count, SCHEMA)
