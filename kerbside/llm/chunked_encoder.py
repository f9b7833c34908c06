"""The tokenizers library applied to distinct chunks of text, for byte-level vocabularies that split at blanks."""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# A task has one core: the library's own threads would only wait for each other and hold memory.
os.environ["TOKENIZERS_PARALLELISM"] = "false"
_AT_ONCE = 256  # texts in the library at a time
_JOINED = 64  # chunks in one of them


class ChunkedEncoder:
    """Ids of whole texts, equal to encoding each text whole without begin, end or added special tokens.

    The byte-level split pattern never joins a character with a blank or newline after it, unless that is white
    space too.  So a text may be cut before every single blank or newline between two other characters, and a
    chunk always has the same ids.  Chunks are words, few compared with their occurrences: each distinct one
    goes to the library once per batch, and up to ``keep`` of them stay for later batches; when there are more,
    those go that no later batch had.  Texts go whole to the library where the tokenizer is of another kind.
    """

    def __init__(self, tokenizer_json: str, keep: int = 300_000):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.cuts = _cuts_at_blanks(json.loads(tokenizer_json))
        self.keep = keep
        self.n_bytes = _token_bytes(self.tokenizer) if self.cuts else None
        self.ids: dict[str, bytes] = {}  # none for a chunk that cannot stand alone
        self.once: set[str] = set()  # those of them that only one batch had
        self.first: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for start in range(0, len(texts), _AT_ONCE)
                for e in self.tokenizer.encode_batch_fast(texts[start:start + _AT_ONCE], add_special_tokens=False)]

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """The same for chunks that may follow each other: joined, and cut by the bytes that each token stands for."""
        if not chunks:
            return []
        groups = ["".join(chunks[i:i + _JOINED]) for i in range(0, len(chunks), _JOINED)]
        payload = b"".join(self._encode(groups))
        token_ends = np.cumsum(self.n_bytes[np.frombuffer(payload, f"<u{self.width}")])
        sizes = map(len, chunks) if all(map(str.isascii, groups)) else map(len, map(str.encode, chunks))
        chunk_ends = np.cumsum(np.fromiter(sizes, np.int64, len(chunks)))
        cuts = [0, *((np.searchsorted(token_ends, chunk_ends) + 1) * self.width).tolist()]
        return [payload[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def payloads(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of ``width`` bytes."""
        if not self.cuts or not texts:
            return self._encode(texts)
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n"), " ")
        ends = split.offsets.to_numpy()
        pieces = pc.dictionary_encode(split.values)
        chunks, heads = (a.to_numpy(zero_copy_only=False).tolist() for a in (pieces.dictionary, split.values.take(split.offsets[:-1])))
        known = self._known(chunks)
        fresh = list(set(heads).difference(self.first))
        self.first.update(zip(fresh, self._encode(fresh), strict=True))
        # The first piece of a text has no blank before it.
        which = pieces.indices.to_numpy().astype(np.int64)
        which[ends[:-1]] = len(chunks) + np.arange(len(texts))
        ids = pa.array([*known, *map(self.first.__getitem__, heads)], pa.large_binary()).take(pa.array(which))
        data, at = ids.buffers()[2], np.frombuffer(ids.buffers()[1], np.int64)[ends].tolist()
        result = [data[a:b].to_pybytes() for a, b in zip(at, at[1:], strict=False)]
        # Texts with a chunk that cannot stand alone.
        alone = np.r_[np.fromiter(map(bool, known), bool, len(known)), [not h[-1:].isspace() for h in heads]]
        for text in np.unique(np.searchsorted(ends, np.flatnonzero(~alone[which]), side="right") - 1):
            result[text] = b"".join(self._encode(list(_groups(texts[text].replace("\n", " \n").split(" ")))))
        if len(self.ids) > self.keep:
            for piece in self.once:
                del self.ids[piece]
            self.once.clear()
        if len(self.first) > self.keep:
            self.first.clear()
        return result

    def _known(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks with a blank before them; none of those that cannot stand alone."""
        known = list(map(self.ids.get, chunks))
        self.once.difference_update(chunks)
        fresh = [c for c, k in zip(chunks, known, strict=True) if k is None]
        self.once.update(fresh)
        # A chunk that strip() gives back has white space at neither end.
        clean = [c for c, s in zip(fresh, map(str.strip, fresh), strict=True) if c is s and c or c is not s and _is_clean(c)]
        self.ids.update(zip(clean, self._encode_chunks([c if c[0] == "\n" else " " + c for c in clean]), strict=True))
        if len(clean) < len(fresh):
            self.ids.update(dict.fromkeys(set(fresh).difference(clean), b""))
        new = map(self.ids.__getitem__, fresh)
        return [next(new) if k is None else k for k in known]


_ENCODERS: dict[str, ChunkedEncoder] = {}  # of this worker process: the tokenizer in use, no more


def worker_encoder(tokenizer_json: str) -> ChunkedEncoder:
    """The encoder of this worker process, which keeps its chunks from task to task."""
    if tokenizer_json not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer_json] = ChunkedEncoder(tokenizer_json)
    return _ENCODERS[tokenizer_json]


def _cuts_at_blanks(spec: dict) -> bool:
    split = spec.get("pre_tokenizer") or {}
    added = [t["content"] for t in spec.get("added_tokens", [])]
    return (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space", True) and not any(c.isspace() for a in added for c in a)
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])))


def _token_bytes(tokenizer: Tokenizer) -> np.ndarray:
    """How many bytes of text each id stands for: byte-level tokens have a character per byte, added ones are themselves."""
    size = tokenizer.get_vocab_size()
    added = tokenizer.get_added_tokens_decoder()
    return np.array([len(added[i].content.encode()) if i in added else len(tokenizer.id_to_token(i) or "") for i in range(size)])


def _is_clean(piece: str) -> bool:
    """Neither end touches white space, but for one newline in front."""
    if piece[:1] == "\n":
        piece = piece[1:]
    return piece != "" and piece.strip() == piece


def _raw(pieces: Iterable[str]) -> str:
    return (" " + " ".join(pieces)).replace(" \n", "\n")


def _groups(pieces: list[str]) -> Iterator[str]:
    """The text again, cut only between two clean pieces."""
    start = 0
    for i in range(1, len(pieces) + 1):
        here_ends = i == len(pieces) or (_is_clean(pieces[i - 1]) or i == 1 and pieces[0] and not pieces[0][-1].isspace()) and _is_clean(pieces[i])
        if here_ends:
            yield _raw(pieces[start:i]) if start else " ".join(pieces[:i]).replace(" \n", "\n")
            start = i
