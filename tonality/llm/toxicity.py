"""Toxicity of whole texts: a bidirectional GRU with attention pooling, in numpy.

Input of a step: the embedding of the word (words seen often enough in training; others
share a zero vector) next to the mean of hashed character n-gram embeddings, so unseen
spellings still carry information.  A forward and a backward GRU run over windows of
``LENGTH`` words; attention pools their states; a logistic unit scores the window.  A
window starts at every word of a text, whatever its length, and the text's score is its
highest window.  Gates and states use x / (1 + |x|) in place of tanh: the recurrence is
bounded alike, and a step needs no exponential.

Training: documents carry the label, not windows.  Statistics of words and of their
character n-grams (a stem whose endings never repeat shows in these alone) over the
training documents nominate the window of a toxic document that speaks most for its label; the
network trains on those against windows of clean documents (of the sample, windows at
every ``STRIDE`` words are taken), then nominates windows itself, and toxic documents in which neither finds anything (label noise) leave the
training set.  Clean windows that score high are trained on again.

The fit uses a bounded sample of labelled rows (``max_toxic``, ``max_clean``,
``max_bytes`` per text): a fixed-size model that learns from a few thousand documents, in
one task of that bounded size; the driver gets the model alone.
Scoring reads every whole text, once, without a shuffle; a worker projects each distinct
word of its batch once and all windows share those projections.
"""

from __future__ import annotations

import itertools
import pickle
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import alnum_words, crc_of_id, prepare, texts, trim_memory

LENGTH = 16
#: Words between the windows of the training sample; scoring takes every window.
STRIDE = 12
HIDDEN, WORD_DIM, CHAR_DIM, ATTEND = 8, 8, 8, 8
#: Buckets of the n-gram embeddings, and of the n-gram counts of the fit; as bits of a hash.
CHAR_BITS, COUNT_BITS = 14, 20
CHAR_BUCKETS = 1 << CHAR_BITS
VOCABULARY = 4096
CHUNK = 2048
#: Weight decay of the embeddings: n-grams that few windows hold are not learned by heart.
DECAY = 1.0
#: Distinct words embedded at a time.
EMBED_WORDS = 8192
#: Rows of one block of a product; times 16 x 24 it is below the size that a BLAS shares out.
BLOCK_ROWS = 512
THRESHOLD = 0.7
#: Deviations no chance maximum over all n-grams reaches: more than this nominates a window.
SURE = 5.0

#: The bounded sample the classifier is fitted on.
MAX_TOXIC, MAX_CLEAN, MAX_BYTES = 2000, 2500, 64 << 10


#: Longer words (texts without spaces) become overlapping pieces of PIECE bytes, a step
#: each, so no n-gram of them is lost.
WORD_BYTES, PIECE, PIECE_STEP = 64, 24, 12
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)
GRAMS = np.array([3, 4, 5])


def gram_hashes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 3- to 5-grams of every word with its ends marked, in a row; and how
    many each word has (at least one)."""
    if not words:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    marked = [b"<" + w + b">" for w in words]
    lens = np.fromiter(map(len, marked), np.int64, len(marked))
    flat = np.frombuffer(b"".join(marked) + b"\0" * GRAMS[-1], np.uint8).astype(np.uint32)
    left = np.repeat(np.cumsum(lens), lens) - np.arange(lens.sum())  # bytes to the word's end
    size = len(left)
    grams = np.empty((size, len(GRAMS)), np.uint32)
    h = flat[:size] * _MULTIPLIERS[0]
    for n in range(2, GRAMS[-1] + 1):
        h = (h ^ flat[n - 1:size + n - 1]) * _MULTIPLIERS[n - 1]
        if n >= GRAMS[0]:
            grams[:, n - GRAMS[0]] = h ^ (h >> np.uint32(15))
    grams *= _MULTIPLIERS[0]
    fits = left[:, None] >= GRAMS
    return grams[fits], np.add.reduceat(fits.sum(1), np.cumsum(lens) - lens)


def char_slots(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding buckets of the n-grams of every word, in a row; and how many each word has."""
    grams, n = gram_hashes(words)
    return (grams >> np.uint32(32 - CHAR_BITS)).astype(np.int32), n


def steps_of(text: bytes | None) -> list[bytes]:
    """Words of a text; those of more than WORD_BYTES bytes as overlapping pieces, cut
    between UTF-8 characters."""
    words = alnum_words(text)
    if not words or max(map(len, words)) <= WORD_BYTES:
        return words
    out = []
    for w in words:
        if len(w) <= WORD_BYTES:
            out.append(w)
            continue
        for lo in range(0, len(w) - PIECE + PIECE_STEP, PIECE_STEP):
            out.append(w[_char_start(w, lo):_char_start(w, lo + PIECE)])
    return out


def _char_start(w: bytes, at: int) -> int:
    """The last place up to ``at`` where a character starts (at most 3 bytes before)."""
    if at >= len(w):
        return len(w)
    for k in range(at, max(-1, at - 4), -1):
        if w[k] & 0xC0 != 0x80:
            return k
    return at


def windows_of(n: int) -> list[int]:
    """Starts of the training windows over ``n`` words: every STRIDE, the last at the end."""
    if n <= LENGTH:
        return [0] if n else []
    starts = list(range(0, n - LENGTH, STRIDE))
    return [*starts, n - LENGTH]


class Encoder:
    """Words of a batch as local numbers, with word and character inputs per number."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.local: dict[bytes, int] = {}
        self.new: list[bytes] = []

    def numbers(self, words: list[bytes]) -> np.ndarray:
        local = self.local
        for w in sorted(set(words).difference(local)):
            local[w] = len(local)
            self.new.append(w)
        return np.fromiter(map(local.__getitem__, words), np.int32, len(words))

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word rows, flat character slots, and how many slots each word has."""
        rows = np.fromiter(map(self.vocabulary.get, words, itertools.repeat(0)), np.int64, len(words))
        return rows, *char_slots(words)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), between -1 and 1; its derivative is (1 - |y|)^2 at the value y."""
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _squash(x))


def _sum_rows(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each place."""
    out = np.zeros((n, rows.shape[1]), np.float32)
    if len(at):
        # 16-bit keys are sorted by radix, several times as fast.
        order = np.argsort(at.astype(np.uint16) if n <= 1 << 16 else at, kind="stable")
        first = np.flatnonzero(np.diff(at[order], prepend=-1))
        out[at[order][first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _product(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w in blocks too small for the BLAS to share out among threads: the same bits
    whatever number of threads a machine has."""
    n = len(x) - len(x) % BLOCK_ROWS
    out = np.empty((len(x), w.shape[1]), np.result_type(x, w))
    np.matmul(x[:n].reshape(-1, BLOCK_ROWS, x.shape[1]), w, out=out[:n].reshape(-1, BLOCK_ROWS, w.shape[1]))
    out[n:] = x[n:] @ w
    return out


def _cross(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x.T @ y by blocks of rows, added up in their order."""
    n = len(x) - len(x) % BLOCK_ROWS
    parts = np.matmul(x[:n].reshape(-1, BLOCK_ROWS, x.shape[1]).transpose(0, 2, 1),
                      y[:n].reshape(-1, BLOCK_ROWS, y.shape[1]))
    return parts.sum(0) + x[n:].T @ y[n:]


class BiGru:
    """Parameters, forward pass and gradients of the network."""

    def __init__(self, vocabulary: dict[bytes, int], seed: int = 0):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        make = lambda *shape, s: (rng.normal(size=shape) * s).astype(np.float32)
        self.vocabulary = vocabulary
        self.p = {
            "word": make(len(vocabulary) + 1, WORD_DIM, s=0.3), "char": make(CHAR_BUCKETS, CHAR_DIM, s=0.5),
            "attend": make(2 * h, ATTEND, s=0.4), "attend_b": np.zeros(ATTEND, np.float32),
            "pick": make(ATTEND, s=0.4), "out": make(2 * h, s=0.4), "out_b": np.full(1, -1.0, np.float32),
        }
        for way in "fb":
            self.p |= {f"w{way}": make(d, 3 * h, s=0.35), f"u{way}": make(h, 3 * h, s=0.3),
                       f"c{way}": np.zeros(3 * h, np.float32)}
        self.p["word"][0] = 0

    def embed(self, rows: np.ndarray, slots: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Inputs of distinct words: [words, WORD_DIM + CHAR_DIM]."""
        if not len(rows):
            return np.zeros((0, WORD_DIM + CHAR_DIM), np.float32)
        at, out = np.cumsum(n) - n, np.empty((len(rows), WORD_DIM + CHAR_DIM), self.p["char"].dtype)
        out[:, :WORD_DIM] = self.p["word"][rows]
        for lo in range(0, len(rows), EMBED_WORDS):
            part = slice(lo, lo + EMBED_WORDS)
            first, end = at[lo], at[part][-1] + n[part][-1]
            sums = np.add.reduceat(self.p["char"][slots[first:end]], at[part] - first, axis=0)
            out[part, WORD_DIM:] = sums / n[part, None].astype(np.float32)
        return out

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Input part of all gates; the last row stands for padding."""
        return {way: np.concatenate([_product(x, self.p[f"w{way}"]) + self.p[f"c{way}"],
                                     np.zeros((1, 3 * HIDDEN), np.float32)]) for way in "fb"}

    def _run(self, way: str, gates: np.ndarray, idx: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        h_dim, u = HIDDEN, self.p[f"u{way}"]
        h = np.zeros((len(idx), h_dim), np.float32)
        states = np.empty((LENGTH, len(idx), h_dim), np.float32)
        order = range(LENGTH) if way == "f" else range(LENGTH - 1, -1, -1)
        full = bool(mask.all())
        for t in order:
            g, r = gates[idx[:, t]], h @ u
            zr = _gate(g[:, :2 * h_dim] + r[:, :2 * h_dim])
            z, s = zr[:, :h_dim], zr[:, h_dim:]
            new = _squash(g[:, 2 * h_dim:] + s * r[:, 2 * h_dim:])
            nxt = h + (1 - z) * (new - h)
            if not full:
                nxt = np.where(mask[:, t, None], nxt, h)
            if keep is not None:
                keep.append((t, h, z, s, new, r[:, 2 * h_dim:]))
            states[t] = h = nxt
        return states

    def forward(self, gates: dict[str, np.ndarray], idx: np.ndarray, mask: np.ndarray,
                tape: dict | None = None) -> np.ndarray:
        """Logit of each window; idx, mask: [windows, LENGTH]."""
        kept: dict = {"f": [], "b": []}
        s = np.concatenate([self._run(w, gates[w], idx, mask, kept[w] if tape is not None else None)
                            for w in "fb"], 2)
        a = _squash(s @ self.p["attend"] + self.p["attend_b"])
        e = a @ self.p["pick"]
        e = np.where(mask.T, e, -1e9)
        w = np.exp(e - e.max(0))
        w /= w.sum(0)
        c = (w[:, :, None] * s).sum(0)
        if tape is not None:
            tape.update(kept=kept, s=s, a=a, w=w, c=c)
        return c @ self.p["out"] + self.p["out_b"]

    def slide(self, gates: dict[str, np.ndarray], flat: np.ndarray) -> np.ndarray:
        """Logit of the window at every place of a row of words (LENGTH or more).

        All windows take one step at once, from one row of gates seen at an offset; of the
        states only what attention and output need is kept."""
        n, h_dim = len(flat) - LENGTH + 1, HIDDEN
        seen = np.zeros((LENGTH, ATTEND + 1, n), np.float32)
        take = np.concatenate([self.p["attend"], self.p["out"][:, None]], 1).T
        # One product a step gives the next step's recurrent part and what is kept of this one.
        both = np.empty((3 * h_dim + ATTEND + 1, n), np.float32)
        zs, new, kept = both[:2 * h_dim], both[2 * h_dim:3 * h_dim], both[3 * h_dim:]
        h, size = np.empty((h_dim, n), np.float32), np.empty((2 * h_dim, n), np.float32)
        half = np.ones((3 * h_dim, 1), np.float32)
        half[2 * h_dim:] = 0.5  # the reset gate is half of 1 + y
        for k, way in enumerate("fb"):
            x = np.ascontiguousarray(gates[way][flat].T)
            w = np.concatenate([self.p[f"u{way}"].T * half, take[:, k * h_dim:(k + 1) * h_dim]])
            h[:], both[:] = 0, 0
            for t in range(LENGTH) if way == "f" else range(LENGTH - 1, -1, -1):
                g = x[:, t:t + n]
                zs += g[:2 * h_dim]
                np.abs(zs, out=size)
                size += 1
                zs /= size
                zs += 1
                new *= zs[h_dim:]
                new += g[2 * h_dim:]
                mine = size[:h_dim]
                np.abs(new, out=mine)
                mine += 1
                new /= mine
                zs[:h_dim] *= 0.5
                h -= new
                h *= zs[:h_dim]
                h += new
                np.matmul(w, h, out=both)
                seen[t] += kept
        a = seen[:, :ATTEND]
        a += self.p["attend_b"][:, None]
        a /= 1 + np.abs(a)
        e = np.einsum("tan,a->tn", a, self.p["pick"])
        w = np.exp(e - e.max(0))
        return (w * seen[:, ATTEND]).sum(0) / w.sum(0) + self.p["out_b"]

    def gradients(self, inputs: tuple, idx: np.ndarray, mask: np.ndarray, y: np.ndarray,
                  weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted mean cross-entropy."""
        rows, slots, n = inputs
        x = self.embed(rows, slots, n)
        gates, tape = self.project(x), {}
        logit = self.forward(gates, idx, mask, tape)
        d = ((_sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        s, a, w, c = tape["s"], tape["a"], tape["w"], tape["c"]
        g = {"out": c.T @ d, "out_b": d.sum(keepdims=True)}
        dc = d[:, None] * self.p["out"]
        ds = w[:, :, None] * dc
        dw = (s * dc).sum(2)
        de = w * (dw - (w * dw).sum(0))
        g["pick"] = np.einsum("tna,tn->a", a, de)
        da = de[:, :, None] * self.p["pick"] * (1 - np.abs(a)) ** 2
        g["attend"], g["attend_b"] = np.einsum("tnh,tna->ha", s, da), da.sum((0, 1))
        ds = ds + da @ self.p["attend"].T
        dx = np.zeros_like(x)
        h_dim = HIDDEN
        for k, way in enumerate("fb"):
            u = self.p[f"u{way}"]
            gu, steps = np.zeros_like(u), []
            dh = np.zeros((len(idx), h_dim), np.float32)
            for t, h, z, r, new, rec in reversed(tape["kept"][way]):
                dh = dh + ds[t][:, k * h_dim:(k + 1) * h_dim]
                on = mask[:, t, None]
                dn = np.where(on, dh, 0)
                d_new = dn * (1 - z) * (1 - np.abs(new)) ** 2
                d_z = dn * (h - new) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                d_r = d_new * rec * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                dg = np.concatenate([d_z, d_r, d_new], 1)
                back = np.concatenate([d_z, d_r, d_new * r], 1)
                steps.append((t, dg))
                gu += h.T @ back
                dh = np.where(on, dn * z, dh) + back @ u.T
            dg_all = _sum_rows(np.concatenate([idx[:, t] for t, _ in steps]),
                               np.concatenate([dg for _, dg in steps]), len(x) + 1)[:len(x)]
            g[f"u{way}"], g[f"w{way}"], g[f"c{way}"] = gu, _cross(x, dg_all), dg_all.sum(0)
            dx += _product(dg_all, self.p[f"w{way}"].T)
        g["word"] = _sum_rows(rows, dx[:, :WORD_DIM], len(self.p["word"]))
        g["word"][0] = 0
        g["char"] = _sum_rows(slots, np.repeat(dx[:, WORD_DIM:] / n[:, None], n, axis=0), CHAR_BUCKETS)
        return g


def _stack(numbers: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The training windows of all documents: document of each window, its word numbers, its mask."""
    lens = np.fromiter(map(len, numbers), np.int64, len(numbers))
    if not lens.sum():
        return np.empty(0, np.int64), np.empty((0, LENGTH), np.int64), np.empty((0, LENGTH), bool)
    flat, at = np.concatenate([*numbers, np.full(LENGTH, pad, np.int32)]), np.cumsum(lens) - lens
    per = np.where(lens <= LENGTH, np.minimum(lens, 1), -(-(lens - LENGTH) // STRIDE) + 1)
    doc = np.repeat(np.arange(len(lens)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    first = np.minimum(nth * STRIDE, np.maximum(0, lens[doc] - LENGTH))
    inside = first[:, None] + np.arange(LENGTH)
    mask = inside < lens[doc][:, None]
    idx = np.where(mask, flat[np.minimum(at[doc][:, None] + inside, len(flat) - 1)], pad)
    return doc, idx, mask


def score_texts(model: BiGru, batch: list[bytes | None]) -> np.ndarray:
    """Score of each text: its highest window, of those at every word; texts without words
    score 0."""
    coder = Encoder(model.vocabulary)
    numbers = [coder.numbers(steps_of(t)) for t in batch]
    gates = model.project(model.embed(*coder.inputs(coder.new)))
    lens = np.fromiter(map(len, numbers), np.int64, len(numbers))
    best = np.full(len(batch), -np.inf)
    short, long = np.flatnonzero((lens > 0) & (lens < LENGTH)), np.flatnonzero(lens >= LENGTH)
    _, idx, mask = _stack([numbers[k] for k in short], len(coder.new))
    for lo in range(0, len(short), CHUNK):
        best[short[lo:lo + CHUNK]] = model.forward(gates, idx[lo:lo + CHUNK], mask[lo:lo + CHUNK])
    if len(long):
        # One row of all long texts; windows that reach into the next text count for none.
        flat = np.concatenate([numbers[k] for k in long])
        logit = np.full(len(flat), -np.inf, np.float32)
        for lo in range(0, len(flat) - LENGTH + 1, CHUNK):
            part = model.slide(gates, flat[lo:lo + CHUNK + LENGTH - 1])
            logit[lo:lo + len(part)] = part
        first = np.cumsum(lens[long]) - lens[long]
        ends = first + lens[long] - LENGTH + 1
        best[long] = np.maximum.reduceat(logit, np.stack([first, ends], 1).ravel()[:2 * len(long)])[::2]
    # Six digits: sums of another batch differ in the last bits, equal texts score alike.
    return np.round(np.where(np.isfinite(best), _sigmoid(np.where(np.isfinite(best), best, 0)), 0.0), 6)


def _is_copy(words: list[bytes], seen: set[tuple[int, int]]) -> bool:
    """Whether a text is an exact or near copy of one before it: copies are one witness."""
    grams = [zlib.crc32(b" ".join(words[k:k + 4])) for k in range(max(1, len(words) - 3))]
    h = np.asarray(grams, np.uint64)
    sketch = [(j, int(((h * np.uint64(m)) & np.uint64(0xFFFFFFFF)).min()))
              for j, m in enumerate((2654435761, 2246822519, 3266489917, 668265263))]
    copy = sum(s in seen for s in sketch) >= 2
    seen.update(sketch)
    return copy


def _excess(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """How far the toxic documents of a feature exceed its share of all, in deviations."""
    return (toxic - clean * share) / np.sqrt(toxic + clean + 1)


def fit(sample: list[tuple[int, bytes, int]], seed: int = 0, steps: int = 500, batch: int = 256) -> BiGru | None:
    """Fit on (id, text, label) rows; None without both classes."""
    coder, seen_texts = Encoder({}), set()
    parts: tuple[list[np.ndarray], list[np.ndarray]] = [], []
    for _, text, y in sorted(sample):
        words = steps_of(text)
        if words and not _is_copy(words, seen_texts):
            parts[0 if y else 1].append(coder.numbers(words))
    toxic, clean = parts
    if not toxic or not clean:
        return None
    n_words = len(coder.new)
    grams, per = gram_hashes(coder.new)
    grams = (grams >> np.uint32(32 - COUNT_BITS)).astype(np.int32)
    ends = np.cumsum(per)
    by_word, by_gram = np.zeros((2, n_words), np.int32), np.zeros((2, 1 << COUNT_BITS), np.int32)
    for k, rows in enumerate(parts):
        for numbers in rows:
            used = np.unique(numbers)
            by_word[k, used] += 1
            count = per[used]
            inside = np.repeat(ends[used] - np.cumsum(count), count) + np.arange(count.sum())
            by_gram[k, np.unique(grams[inside])] += 1
    share = len(toxic) / len(clean)
    z = _excess(by_word[0], by_word[1], share)
    z_gram = _excess(by_gram[0], by_gram[1], share)
    z_of = np.append(np.maximum(z, np.maximum.reduceat(z_gram[grams], ends - per)), -9.0)  # last: padding
    del grams, by_gram, z_gram
    total, names = by_word.sum(0), coder.new
    telling = sorted(np.flatnonzero((z > 1.5) & (by_word[0] > 0)), key=lambda w: (-z[w], names[w]))[:VOCABULARY // 2]
    common = sorted(np.flatnonzero(total >= 5), key=lambda w: (-total[w], names[w]))
    vocabulary: dict[bytes, int] = {}
    for w in [*telling, *common]:
        if len(vocabulary) < VOCABULARY:
            vocabulary.setdefault(names[w], len(vocabulary) + 1)
    rng = np.random.default_rng(seed)
    model = BiGru(vocabulary, seed)
    coder.vocabulary = vocabulary
    inputs = coder.inputs(coder.new)
    doc, idx, mask = _stack([*toxic, *clean], n_words)
    is_toxic = doc < len(toxic)
    speaks = z_of[idx].max(1)

    def top(value: np.ndarray) -> np.ndarray:
        """The window of each toxic document with the highest value."""
        mine = np.flatnonzero(is_toxic)
        order = mine[np.lexsort((-value[mine], doc[mine]))]
        return order[np.unique(doc[order], return_index=True)[1]]

    def scores() -> np.ndarray:
        gates = model.project(model.embed(*inputs))
        return np.concatenate([model.forward(gates, idx[k:k + batch], mask[k:k + batch])
                               for k in range(0, len(idx), batch)])

    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    tick = 0

    def train(positive: np.ndarray, negative: np.ndarray, steps: int, rate: float) -> None:
        """Positive windows keep their most telling word; each other word is replaced half
        the time by one of a clean window, so that context cannot be learned by heart."""
        nonlocal tick
        rows, slots, n = inputs
        at = np.cumsum(n) - n
        for _ in range(steps):
            pick = np.concatenate([rng.choice(positive, batch // 2), rng.choice(negative, batch // 2)])
            seen = idx[pick]
            half = seen[:batch // 2]
            other = idx[rng.choice(quiet, len(half))]
            swap = (rng.random(half.shape) < 0.5) & (other < n_words) & mask[pick[:len(half)]]
            swap[np.arange(len(half)), z_of[half].argmax(1)] = False
            seen[:len(half)] = np.where(swap, other, half)
            used, local = np.unique(seen, return_inverse=True)
            used = used[used < n_words]  # the pad number is the largest
            count = n[used]
            take = slots[np.repeat(at[used] - (np.cumsum(count) - count), count) + np.arange(count.sum())]
            y = np.repeat([1.0, 0.0], [batch // 2, len(pick) - batch // 2]).astype(np.float32)
            grads = model.gradients((rows[used], take, count), local.reshape(len(pick), LENGTH), mask[pick], y,
                                    np.ones(len(pick), np.float32))
            tick += 1
            for k, g in grads.items():
                m, v = state[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                if k in ("word", "char"):
                    model.p[k] *= np.float32(1 - rate * DECAY)
                model.p[k] -= (rate * (m / (1 - 0.9 ** tick)) / (np.sqrt(v / (1 - 0.999 ** tick)) + 1e-8)).astype(np.float32)

    quiet = np.flatnonzero(~is_toxic)
    by_words = top(speaks)
    limit = max(1.5, min(SURE, float(np.quantile(speaks[by_words], 0.75)) / 2))
    sure = by_words[speaks[by_words] >= limit]
    train(sure, quiet, steps, 0.01)
    for _ in range(2):
        s = scores()
        best = top(s)
        sure = best[s[best] > -0.5]
        if not len(sure):
            break
        hard = quiet[np.argsort(-s[quiet])[:max(64, len(quiet) // 50)]]
        train(sure, np.concatenate([np.repeat(hard, max(1, len(quiet) // len(hard) // 2)), quiet]), steps // 2, 0.005)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, keep: Column, max_toxic: int = MAX_TOXIC,
                    max_clean: int = MAX_CLEAN, max_bytes: int = MAX_BYTES) -> DataFrame | None:
    """Bounded sample for the fit: per class the rows of the smallest hashed ids,
    as (doc_id, toxic, text); None if there are no ids.

    ``keep``: condition on ``doc_id``.  Ids with contradicting, null or other labels than
    0 and 1 are left out, as are texts above ``max_bytes``."""
    y = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    y = (y.where(keep & F.col("doc_id").isNotNull()).groupBy("doc_id")
         .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("hi"), F.count("toxic").alias("n"))
         .where("toxic = hi AND toxic IN (0, 1) AND n > 0"))
    # At most max_toxic + max_clean ids: small enough to broadcast.
    chosen = None
    for value, most in ((1, max_toxic), (0, max_clean)):
        part = y.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    ids = [(r.doc_id, r.toxic) for r in chosen.collect()]
    if not ids:
        return None
    spark = docs.sparkSession
    few = F.broadcast(spark.createDataFrame(ids, "doc_id bigint, toxic int"))
    rows = texts(docs).where(F.col("text").isNotNull() & (F.length("text") <= max_bytes)).join(few, "doc_id")
    # A repeated id keeps its smallest text.
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def train_toxicity(docs: DataFrame, labels: DataFrame, keep: Column | None = None, **bounds: int) -> BiGru | None:
    """Fit on the labelled rows whose ``doc_id`` meets ``keep``, in one task (a lost one is
    fitted again, to the same model); the model is all that the driver gets."""
    prepare(docs.sparkSession)
    sample = labelled_sample(docs, labels, F.lit(True) if keep is None else keep, **bounds)
    if sample is None:
        return None

    def run(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        trim_memory()
        rows = [r for b in it for r in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic")))]
        model = fit(rows)
        del rows
        trim_memory()
        if model is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    got = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(got[0].model) if got else None


def score_documents(docs: DataFrame, model: BiGru | None, score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` (an equally named one is replaced) plus the score (0 to 1).

    Null and empty texts score 0; without a model (no labels of both classes) all do."""
    spark = docs.sparkSession
    prepare(spark)
    keep = [c for c in docs.columns if c != score_col]
    base = docs.select(*[docs[c] for c in keep])
    if model is None:
        return base.withColumn(score_col, F.lit(0.0))
    shared = spark.sparkContext.broadcast(model)
    at = keep.index("text")
    schema = StructType([*base.schema.fields, StructField(score_col, DoubleType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in it:
            text = b.column(at).cast(pa.binary()).to_pylist()
            score = score_texts(shared.value, text)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], names=[*keep, score_col])
        trim_memory()

    return base.mapInArrow(run, schema)


def is_held_out() -> Column:
    """Whether a row is held out by its id; rows without an id are not."""
    return F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(3)) == 1, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train_toxicity(docs, labels, ~is_held_out())
    scored = score_documents(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", is_held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
