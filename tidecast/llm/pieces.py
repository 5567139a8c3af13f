"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The model file gives pieces, scores, types and the white-space settings.  Pieces are kept in a
double-array trie over their bytes (``base[s] + byte`` is the child of state ``s`` if its ``check`` is
``s``).  A text's white space becomes the marker U+2581; no piece has the marker behind another character, so
the best segmentation of a text is that of its words, one after the other.  Words are segmented
in batches: the dynamic program runs over byte positions, all words at once.  Characters that no piece covers
fall back to their bytes.  Decoding joins pieces, gathers byte pieces, and turns markers into spaces.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import process_cache

MARK = "▁"
#: A byte piece costs this much more than the worst piece, an unknown character still more.
PENALTY = 10.0
CACHE_WORDS = 800_000
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6  # fixed values of the model format
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _fields(buf: bytes):
    """(number, value) of the fields of a protocol-buffer message."""
    i = 0

    def varint():
        nonlocal i
        v = shift = 0
        while True:
            b = buf[i]
            i += 1
            v |= (b & 127) << shift
            if b < 128:
                return v
            shift += 7

    while i < len(buf):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield tag >> 3, buf[i:i + n]
            i += n


@dataclass
class Model:
    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    dummy_prefix: bool = True
    squeeze: bool = True

    def __post_init__(self):
        self.unknown = int(np.flatnonzero(self.kinds == _UNKNOWN)[0])
        self.bytes_ids = np.full(256, -1, dtype=np.int32)
        for i in np.flatnonzero(self.kinds == _BYTE):
            self.bytes_ids[int(self.pieces[i][3:5], 16)] = i
        usable = np.flatnonzero((self.kinds == _NORMAL) | (self.kinds == _USER))
        low = float(self.scores[usable].min()) if len(usable) else 0.0
        self.byte_cost, self.unknown_cost = low - PENALTY, low - 2 * PENALTY
        self.by_words = not any(MARK in self.pieces[i].lstrip(MARK) for i in usable)
        self.trie = double_array([(self.pieces[i].encode(), int(i)) for i in usable])


def load(path: str, log_rank: bool = True) -> Model:
    """Read a ``.model`` file.  Its vocabulary may come from merges, whose scores are ranks (0, -1, -2, ...),
    no logarithms; ``log_rank`` turns these into log scores by Zipf's law: -log(rank + 1)."""
    pieces, scores, kinds, settings = [], [], [], {}
    for number, value in _fields(open(path, "rb").read()):
        if number == 1:
            own = dict(_fields(value))
            pieces.append(own.get(1, b"").decode())
            scores.append(float(np.frombuffer(own[2], "<f4")[0]) if 2 in own else 0.0)
            kinds.append(own.get(3, _NORMAL))
        elif number == 3:
            settings = dict(_fields(value))
    scores = np.array(scores)
    kinds = np.array(kinds)
    scores[kinds == _USER] = 0.0
    scores = np.maximum(scores, -1e6)
    if log_rank:
        scores = -np.log1p(-np.minimum(scores, 0))
    return Model(pieces, scores, kinds, bool(settings.get(3, 1)), bool(settings.get(4, 1)))


def double_array(words: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base``, ``check`` and ``value`` (-1: no piece ends here) of a trie; state 0 is the root."""
    children: list[dict[int, int]] = [{}]
    value: list[int] = [-1]
    for word, v in words:
        s = 0
        for b in word:
            if b not in children[s]:
                children[s][b] = len(children)
                children.append({})
                value.append(-1)
            s = children[s][b]
        value[s] = v
    size = 2 * len(children) + 1024
    base, check, out = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = bytearray(size)
    used[0], place, free = 1, {0: 0}, 1
    queue = [0]
    for node in queue:
        kids = children[node]
        s = place[node]
        out[s] = value[node]
        if not kids:
            continue
        keys = sorted(kids)
        while used[free]:
            free += 1
        tries, b = 0, max(free - keys[0], 1)
        while any(used[b + k] for k in keys):
            b += 1
            tries += 1
            if tries % 64 == 0 and len(keys) > 1:  # crowded: later nodes start further on
                free += 16
            if b + 256 >= len(used):
                grow = len(used)
                used += bytearray(grow)
                base, check, out = (np.concatenate([a, np.full(grow, f, np.int32)]) for a, f in ((base, 0), (check, -1), (out, -1)))
        base[s] = b
        for k in keys:
            used[b + k], check[b + k], place[kids[k]] = 1, s, b + k
            queue.append(kids[k])
    # base + byte may point anywhere up to 255 behind the last state
    pad = np.full(256, -1, np.int32)
    return np.append(base, np.zeros(256, np.int32)), np.append(check, pad), np.append(out, pad)


def viterbi(model: Model, words: list[bytes]) -> list[np.ndarray]:
    """Best ids of every word.  Ties: the longer last piece."""
    base, check, value = model.trie
    n = len(words)
    size = np.array([len(w) for w in words])
    most = int(size.max(initial=0))
    text = np.zeros((n, most + 1), dtype=np.int32)
    for i, w in enumerate(words):
        text[i, :len(w)] = np.frombuffer(w, dtype=np.uint8)
    starts = np.arange(most + 1)[None, :] < size[:, None]
    starts &= (text & 0xC0) != 0x80  # positions where a character begins
    length = np.where(text < 0x80, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
    best = np.full((n, most + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((n, most + 1), dtype=np.int32)  # where the last piece begins
    piece = np.full((n, most + 1), -1, dtype=np.int32)
    for i in range(most):
        at = np.flatnonzero(starts[:, i] & (best[:, i] > -np.inf))
        if not len(at):
            continue
        # fallback of one character
        end = np.minimum(i + length[at, i], size[at])
        if (model.bytes_ids >= 0).all():
            cost = best[at, i] + model.byte_cost * (end - i)
        else:
            cost = best[at, i] + model.unknown_cost
        better = cost > best[at, end]
        best[at[better], end[better]] = cost[better]
        back[at[better], end[better]] = i
        piece[at[better], end[better]] = -1
        state, rows = np.zeros(len(at), dtype=np.int64), at
        for j in range(i, most):
            nxt = base[state] + text[rows, j]
            ok = (j < size[rows]) & (check[nxt] == state)
            if not ok.any():
                break
            state, rows = nxt[ok], rows[ok]
            v = value[state]
            hit = v >= 0
            if hit.any():
                r, p = rows[hit], v[hit]
                cost = best[r, i] + model.scores[p]
                better = cost > best[r, j + 1]
                r, p = r[better], p[better]
                best[r, j + 1] = cost[better]
                back[r, j + 1] = i
                piece[r, j + 1] = p
    out = []
    for i, w in enumerate(words):
        ids, j = [], len(w)
        while j > 0:
            b, p = int(back[i, j]), int(piece[i, j])
            if p >= 0:
                ids.append(p)
            elif (model.bytes_ids >= 0).all():
                ids += model.bytes_ids[np.frombuffer(w[b:j], dtype=np.uint8)][::-1].tolist()
            else:
                ids.append(model.unknown)
            j = b
        out.append(np.array(ids[::-1], dtype=np.int32))
    return out


class Codec:
    """Encodes and decodes texts, remembering the words it has segmented."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.surface = [b"" if k == _CONTROL else p.encode() for p, k in zip(model.pieces, model.kinds)]
        for b, i in enumerate(model.bytes_ids):
            if i >= 0:
                self.surface[i] = bytes([b])
        self.surface[model.unknown] = " ⁇ ".encode()

    def _normal(self, text: str) -> str:
        if self.model.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK)

    def _learn(self, words: list[str]) -> None:
        words.sort(key=len)  # so that a batch pads little
        lo = 0
        while lo < len(words):
            hi = min(len(words), lo + max(1, 200_000 // (4 * len(words[lo]) + 8)))
            while hi > lo + 1 and len(words[hi - 1]) > 2 * len(words[lo]) + 8:
                hi = lo + (hi - lo) // 2
            raw = [w.encode("utf-8", "replace") for w in words[lo:hi]]
            self.known.update(zip(words[lo:hi], (a.tobytes() for a in viterbi(self.model, raw))))
            lo = hi

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = []
        for t in texts:
            t = self._normal(t)
            cut.append(_WORD.findall(t) if self.model.by_words else [t] * bool(t))
        known = self.known
        new, full = list({w for words in cut for w in words if w not in known}), len(known) >= CACHE_WORDS
        self._learn(new)
        out = [np.frombuffer(b"".join([known[w] for w in words]), dtype=np.int32) for words in cut]
        for w in new if full else ():
            del known[w]
        return out

    def decode(self, ids) -> str:
        raw = b"".join([self.surface[i] for i in ids])
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def _codec(path: str) -> Codec:
    cache = process_cache()
    if ("codec", path) not in cache:
        cache["codec", path] = Codec(load(path))
    return cache["codec", path]


def _chunks(texts: list, chars: int = 2_000_000):
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi] or "") < chars):
            size += len(texts[hi] or "")
            hi += 1
        yield texts[lo:hi]
        lo = hi


def encode(text: Column, model: str) -> Column:
    """Ids (array<int>) of ``text`` under the model file at the path ``model``; a null or empty text has none."""
    @F.pandas_udf("array<int>")
    def ids(t: pd.Series) -> pd.Series:
        return pd.Series([x for part in _chunks(t.tolist()) for x in _codec(model).encode([s or "" for s in part])])

    return ids(text)


def decode(ids: Column, model: str) -> Column:
    """The text of ids; null ids give an empty text."""
    @F.pandas_udf("string")
    def text(a: pd.Series) -> pd.Series:
        return pd.Series([_codec(model).decode(x) if x is not None else "" for x in a], dtype=object)

    return text(ids)


def digest(text: Column, model: str) -> Column:
    """Struct of the encoding of ``text``: ``n_tokens``, ``n_bytes_tokens`` (byte fallback), ``ids_crc32`` (of little-endian
    unsigned 32-bit ids), ``decoded`` (whether decoding gives the text back)."""
    @F.pandas_udf("n_tokens long, n_byte_tokens long, ids_crc32 long, decoded boolean")
    def summary(t: pd.Series) -> pd.DataFrame:
        codec, out = _codec(model), []
        fall = codec.model.kinds == _BYTE
        for part in _chunks(t.tolist()):
            part = [s or "" for s in part]
            for s, ids in zip(part, codec.encode(part)):
                out.append((len(ids), int(fall[ids].sum()), zlib.crc32(ids.astype("<u4").tobytes()), codec.decode(ids.tolist()) == s))
        return pd.DataFrame(out, columns=["n_tokens", "n_byte_tokens", "ids_crc32", "decoded"])

    return summary(text)
