"""Exact, bounded-memory encoding with a `tokenizers` file on Arrow batches.

Byte-level BPE with the usual pre-tokenizer never forms a token across two kinds
of position: before a white-space character that is followed by a visible one
(a run of white space is cut before its last character in any case), and
between a letter or digit and punctuation other than an apostrophe. Texts are
cut there, each distinct piece of a batch is encoded once (a worker keeps the
ids of pieces it has seen, up to a bound) and the ids are gathered by piece.
The result equals encoding the whole text; the tests compare the two, also on
odd white space, contractions, special tokens and non-Latin text.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from carebook.llm.worker_memory import keep

# Texts are cut before white space only if the byte after it is none of these:
# white space, or the first byte of a UTF-8 white-space character.
_NO_CUT_AFTER = np.zeros(256, bool)
_NO_CUT_AFTER[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True

SLICE_BYTES = 4 << 20
ENCODE_BYTES = 256 << 10


class PieceEncoder:
    """Ids of whole texts; keeps the ids of at most ``max_kept`` pieces."""

    def __init__(self, path: str, max_kept: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.byte_length = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.byte_length[i] = len(token)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.byte_length[i] = len(token.content.encode())
        # Punctuation before which a word may be cut: none that lies inside a special token.
        inside = {c for t in self.tokenizer.get_added_tokens_decoder().values() for c in t.content[1:]}
        self.punctuation = np.zeros(256, bool)
        self.punctuation[[c for c in range(33, 127) if not _WORD[c] and chr(c) not in inside | {"'"}]] = True
        self.max_kept = max_kept
        self.slot: dict[bytes, int] = {}
        self.ends = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _encode_new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces in one array, and where each piece's ids end."""
        out: list[np.ndarray] = []
        lengths = np.zeros(len(pieces), np.int64)
        at, run, size = 0, [], 0

        def flush() -> None:
            nonlocal run, size
            if run:
                ids = np.array(self.tokenizer.encode(b"".join(pieces[i] for i in run).decode(),
                                                     add_special_tokens=False).ids, np.int32)
                ends = np.cumsum([len(pieces[i]) for i in run])
                upto = np.searchsorted(np.cumsum(self.byte_length[ids]), ends) + 1
                lengths[run] = np.diff(upto, prepend=0)
                out.append(ids)
            run, size = [], 0

        for at, piece in enumerate(pieces):
            if not _follows(piece):
                flush()
                ids = self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids
                out.append(np.array(ids, np.int32))
                lengths[at] = len(ids)
                continue
            run.append(at)
            size += len(piece)
            if size >= ENCODE_BYTES:
                flush()
        flush()
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), np.cumsum(lengths)

    def _ids_of(self, pieces: list[bytes]) -> pa.ListArray:
        slot = self.slot
        found = np.fromiter((slot.get(p, -1) for p in pieces), np.int64, len(pieces))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            # Pieces that begin with white space first, to be encoded in long runs.
            missing = missing[np.argsort([not _follows(pieces[i]) for i in missing], kind="stable")]
            ids, ends = self._encode_new([pieces[i] for i in missing])
            base = len(self.ends) - 1
            all_ids = np.concatenate([self.ids, ids])
            all_ends = np.concatenate([self.ends, self.ends[-1] + ends])
            found[missing] = base + np.arange(len(missing))
            if base + len(missing) <= self.max_kept:
                self.ids, self.ends = all_ids, all_ends
                slot.update(zip((pieces[i] for i in missing), found[missing].tolist()))
        else:
            all_ids, all_ends = self.ids, self.ends
        return gather(all_ids, all_ends, found)

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """``list<int32>`` of ids for each text; null counts as the empty text."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        low, high = int(offsets[0]), int(offsets[-1])
        if low == high:
            return pa.ListArray.from_arrays(pa.array(np.zeros(len(texts) + 1, np.int32)),
                                            pa.array(np.zeros(0, np.int32)))
        data = texts.buffers()[2].slice(low, high - low)
        raw = np.frombuffer(data, np.uint8)
        cut = np.zeros(len(raw) + 1, bool)
        cut[:-2] = _WHITE[raw[:-1]] & ~_NO_CUT_AFTER[raw[1:]]
        cut[1:-1] |= _WORD[raw[:-1]] & self.punctuation[raw[1:]]
        cut[offsets - low] = True
        cuts = np.flatnonzero(cut)
        pieces = pa.Array.from_buffers(pa.binary(), len(cuts) - 1,
                                       [None, pa.py_buffer(cuts.astype(np.int32)), data]).dictionary_encode()
        per_piece = self._ids_of(pieces.dictionary.to_pylist()).take(pieces.indices)
        ends = np.frombuffer(per_piece.buffers()[1], np.int32)[per_piece.offset:per_piece.offset + len(per_piece) + 1]
        return pa.ListArray.from_arrays(pa.array(ends[np.searchsorted(cuts, offsets - low)]), per_piece.values)


def _follows(piece: bytes) -> bool:
    """Whether a piece keeps its ids after any other one: it begins with white space and a visible character."""
    return len(piece) > 1 and bool(_WHITE[piece[0]]) and not _NO_CUT_AFTER[piece[1]]


def gather(ids: np.ndarray, ends: np.ndarray, which: np.ndarray) -> pa.ListArray:
    """The runs of ``ids`` numbered ``which``; run i is ids[ends[i]:ends[i + 1]]."""
    lengths = (ends[1:] - ends[:-1])[which]
    upto = np.cumsum(lengths)
    total = int(upto[-1]) if len(upto) else 0
    at = np.arange(total) + np.repeat(ends[which] - (upto - lengths), lengths)
    offsets = np.zeros(len(which) + 1, np.int32)
    offsets[1:] = upto
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[at]))


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for this file."""
    return keep(("tokens", path), lambda: PieceEncoder(path))


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES):
    """``batch`` in runs of rows whose ``column`` holds about ``most`` bytes (one row at least)."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, first = np.cumsum(sizes), 0
    while first < batch.num_rows:
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def list_parts(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list array, as numpy arrays that fit each other."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return offsets, lists.values.to_numpy()


def with_end_id(lists: pa.ListArray, end_id: int) -> pa.ListArray:
    """Each list followed by ``end_id``."""
    offsets, values = list_parts(lists)
    n = len(offsets) - 1
    values = values[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    out = np.empty(len(values) + n, np.int32)
    ends = offsets[1:] + np.arange(n)
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep], out[ends] = values, end_id
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends + 1]).astype(np.int32)), pa.array(out))
