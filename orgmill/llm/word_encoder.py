"""Token ids of whole texts by a `tokenizers` file whose pre-tokeniser never crosses ASCII white space.

Words repeat, so each distinct word of a worker is encoded once by the library itself and its ids are reused;
a known word is found by a 64-bit hash, so the memory holds numbers only.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from orgmill.llm.common import BYTE_CODE, buffers, keep_until_others, ragged, word_hashes

#: Distinct words kept by a worker; beyond it the memory starts anew. It changes speed only.
MEMORY_WORDS = 1_200_000
#: Those kept between tasks.
KEPT_WORDS = 200_000
#: Words that the library encodes at once: its result takes about 1 KB for each of them.
LEARNT_WORDS = 8192

#: The normaliser and the split of files whose texts may be cut as WordEncoder cuts them.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}

WORDS = "words"
_encoders: dict[str, "WordEncoder"] = {}


def word_encoder(path: str) -> "WordEncoder":
    """One encoder for each Python worker and file, for tasks that are lean(..., WORDS); the first other lean task forgets it."""
    keep_until_others(WORDS, _encoders.clear)
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class WordEncoder:
    """ids(texts) equals the library's encode() of each text without added special tokens.

    Safe cuts, for a file that lower-cases and whose pattern yields runs of letters, single digits and runs of
    other marks: at ASCII white space, and between an ASCII letter and a following full stop or comma. ASCII
    letters are lower-cased first. Texts that contain a special token's opening mark go to the library whole; with a file
    of another kind all texts do.
    """

    def __init__(self, path: str, memory_words: int = MEMORY_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()]
        kind = json.loads(self.tokenizer.to_str())
        before = (kind.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.cuts = kind.get("normalizer") == NORMALIZER and before[0].get("pattern") == SPLIT and not kind.get("truncation") and not kind.get("padding")
        self.memory_words = memory_words
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # of known words, by hash
        self.first, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0

    def keep(self, words: int = KEPT_WORDS) -> None:
        """Forgets all but the words that were learnt first, which are the frequent ones: Spark keeps workers for other operators'
        tasks, and what a task has learnt at last is of little use to the next."""
        if len(self.hashes) <= words:
            return
        own = self.rows < words
        self.hashes, self.rows = self.hashes[own], self.rows[own]
        self.used = int(self.first[words - 1] + self.count[words - 1])
        self.first, self.count, self.flat = self.first[:words].copy(), self.count[:words].copy(), np.append(self.flat[: self.used], np.zeros(1024, np.uint32))  # room to double

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        lengths, ids = [], []
        for a in range(0, len(words), LEARNT_WORDS):
            new = [x.ids for x in self.tokenizer.encode_batch_fast(words[a : a + LEARNT_WORDS], add_special_tokens=False)]
            lengths.append(np.fromiter(map(len, new), np.int64, len(new)))
            ids.append(np.fromiter((i for x in new for i in x), np.uint32, int(lengths[-1].sum())))
        counts = np.concatenate(lengths)
        n, size, total = len(self.hashes), len(counts), int(counts.sum())
        while len(self.first) < n + size:
            self.first, self.count = np.concatenate([self.first, self.first]), np.concatenate([self.count, self.count])
        while len(self.flat) < self.used + total:
            self.flat = np.concatenate([self.flat, self.flat])
        self.first[n : n + size] = self.used + np.cumsum(counts) - counts
        self.count[n : n + size] = counts
        self.flat[self.used : self.used + total] = np.concatenate(ids)
        self.used += total
        order = np.argsort(hashes)
        place = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.rows = np.insert(self.hashes, place, hashes[order]), np.insert(self.rows, place, n + order)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.rows[at], self.hashes[at] == hashes

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and len(texts) + 1 offsets into them."""
        if not self.cuts:
            found = [x.ids for x in self.tokenizer.encode_batch_fast([x or "" for x in texts.to_pylist()], add_special_tokens=False)]
            return np.fromiter((i for x in found for i in x), np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
        data, offsets = buffers(texts)  # without an offset: on a slice, ascii_lower reads the wrong bytes
        texts = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(data))
        marked = np.zeros(len(texts), bool)
        for mark in self.special:
            marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(~marked), texts, pa.scalar("", pa.large_string())) if marked.any() else texts
        plain = pc.replace_substring_regex(pc.ascii_lower(plain), "([a-z])([.,])", r"\1 \2")
        split = pc.ascii_split_whitespace(plain)
        bounds = np.frombuffer(split.buffers()[1], np.int64 if pa.types.is_large_list(split.type) else np.int32)[: len(texts) + 1].astype(np.int64)
        coded = split.flatten().dictionary_encode()
        letters, edges = buffers(coded.dictionary)
        with np.errstate(over="ignore"):
            hashes = word_hashes(letters, edges[:-1], edges[1:], BYTE_CODE)
        if len(self.hashes) > self.memory_words:
            self._forget()
        fresh = np.flatnonzero(~self._find(hashes)[1])
        if len(fresh):
            self._learn(coded.dictionary.take(pa.array(fresh)).to_pylist(), hashes[fresh])
        where = self._find(hashes)[0]
        word = where[coded.indices.to_numpy(zero_copy_only=False)] if len(hashes) else np.zeros(0, np.int64)
        counts = self.count[word]
        flat = self.flat[ragged(self.first[word], counts)]
        bounds = bounds - bounds[0]
        offsets = np.concatenate([[0], np.cumsum(counts)])[bounds]
        if not marked.any():
            return flat, offsets
        parts = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        for i in np.flatnonzero(marked).tolist():
            parts[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
