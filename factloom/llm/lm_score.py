"""Language-model scoring: causal self-attention on subword ids, beside a word-count base.

The model reads a text as its lower-cased words' ids of the public byte-level BPE and an
end.  A token's probability is one softmax over the tokens before it in the window and a
sink: attention (query from the token just before, keys from each earlier token's own
predecessor, a bias for the distance) puts its weight on earlier tokens, which predict
themselves; the sink's weight goes to a prior: a word's first subword given the word
before's first, every further one (or the word's end) given all of the word so far, with
absolute discounting and back-off.  Windows are two blocks long and overlap by one, so
every token is scored once, with one to two blocks of context, and whole batches of
windows are one masked attention.

Attention weights are trained in numpy on all training documents: every task learns from its
own, a bounded part at a time, and the tasks' weights are averaged, each token's by how often
a task saw it.  The base's word counts and the prior's counts cover all training documents
too: what a slice of texts holds is
dealt to buckets by hash, as packed arrays, and every bucket counts over all slices and
gives each slice its own counts back.  Only sums by subword, of fixed size, are broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.arrow import freed, slices_of
from factloom.llm.hashing import ODD, SPACE, distinct, masses, mixed, ordered, powers, spans
from factloom.llm.tokens import encoder
from factloom.llm.toxicity import held_out
from factloom.session import dropped, shuffle_partitions, written

VOCABULARY, END = 50_257, 50_256
BLOCK, DIM, DISCOUNT = 16, 16, 0.75
#: Characters of text whose counts one bucket holds on average: what bounds a counting task, whatever the corpus.
BUCKET = 1 << 25
#: Documents, and about how many characters of them, whose words are packed together, or that attention learns from at once.
SLICE, CHARACTERS = 1024, 1 << 22
#: Blocks of one step of learning.
BATCH = 1024
#: Blocks whose attention is worked out at once: their numbers stay in a core's cache.
NEAR = 128
#: The end of a text as a word of the base.
END_WORD = mixed(np.array([END], np.uint64))[0]


@dataclass
class Slice:
    """Words and subword ids of some texts."""

    names: np.ndarray  # distinct words' hashes
    word: np.ndarray  # of each word occurrence the distinct word
    edges: np.ndarray  # where each text's words begin
    ids: np.ndarray  # subword ids of the distinct words, one after another
    cuts: np.ndarray  # where each distinct word's begin

    @cached_property
    def transitions(self) -> tuple[np.ndarray, ...]:
        return _transitions(self)

    @cached_property
    def inside(self) -> tuple[np.ndarray, ...]:
        return _inside(self)

    @cached_property
    def heads(self) -> tuple[np.ndarray, ...]:
        """Distinct pairs of neighbouring words' first subwords; one place of each; each place's pair."""
        return distinct(_heads(self))


_STARTS_WORD: list[np.ndarray] = []


def _starts_word() -> np.ndarray:
    """Which ids begin with a space."""
    if not _STARTS_WORD:
        import base64

        import public_tokenizers as public

        found = np.zeros(VOCABULARY, bool)
        with open(public.path("byte_bpe_50k.tiktoken"), "rb") as f:
            for token, rank in map(bytes.split, f):
                found[int(rank)] = base64.b64decode(token)[:1] == b" "
        _STARTS_WORD.append(found)
    return _STARTS_WORD[0]


def sliced(texts: list[str]) -> Slice:
    """A-Z lower-cased; words are runs of anything but space and the control characters 9 to 13."""
    parts = [t.encode("utf-8", "replace").lower() for t in texts]
    raw = b"\n".join([*parts, b""])
    data = np.frombuffer(raw or b"\n", np.uint8)
    space = SPACE[data]
    begin, end = ~space, space.copy()
    begin[1:] &= space[:-1]
    end[1:] &= ~space[:-1]
    end[0] = False
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    edges = np.searchsorted(starts, np.cumsum([0] + [len(p) + 1 for p in parts]))
    names, first, word = distinct(spans(masses(data), starts, ends))
    a, b = starts[first], ends[first]
    size = b - a + 1
    begins = np.cumsum(size) - size
    text = data.take(np.arange(size.sum()) + np.repeat(a - 1 - begins, size))  # every word behind one byte, which becomes a space
    text[begins] = 32
    ids = np.frombuffer(encoder()(text.tobytes().decode("utf-8", "replace")), "<u4").astype(np.int32)
    cuts = np.flatnonzero(_starts_word()[ids])
    if len(cuts) != len(names):  # a word holds white space that only Unicode knows: one by one
        each = [np.frombuffer(encoder()(" " + raw[i:j].decode("utf-8", "replace")), "<u4").astype(np.int32) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        ids, cuts = np.concatenate([np.zeros(0, np.int32), *each]), np.cumsum([0] + [len(x) for x in each])[:-1]
    return Slice(names, word, edges, ids, np.append(cuts, len(ids)))


def stream(s: Slice, prior: Prior | Counted | Halves) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Subword ids of all texts, an end after each; each one's prior probability; where each text's begin."""
    inner, last = prior.words(s)
    sizes = np.diff(s.cuts)[s.word]
    words_in = np.diff(s.edges)
    total = np.concatenate([[0], np.cumsum(sizes)])
    begin = np.concatenate([[0], np.cumsum(total[s.edges[1:]] - total[s.edges[:-1]] + 1)])
    ids, chance = np.full(begin[-1], END, np.int32), np.ones(begin[-1], np.float32)
    text = np.repeat(np.arange(len(words_in)), words_in)
    source = np.arange(total[-1]) - np.repeat(total[:-1] - s.cuts[s.word], sizes)
    at = np.arange(total[-1]) + np.repeat(text, sizes)
    ids[at], chance[at] = s.ids.take(source), inner.take(source)
    # what follows a word: the next word's first subword, or the text's end
    marks, opening = np.zeros(begin[-1], bool), np.zeros(begin[-1], bool)
    marks[total[:-1] + text] = marks[begin[1:] - 1] = opening[begin[:-1]] = True
    first = np.flatnonzero(marks)
    opens = opening[first]
    context, ended = np.full(len(first), END, np.int32), np.ones(len(first), np.float32)
    follows = np.flatnonzero(~opens)
    context[follows] = ids[first[follows - 1]]
    ended[follows] = last[s.word]
    chance[first] = ended * prior.first(context, ids[first])
    return ids, chance, begin


class Bigrams:
    """Shares of (context, next) counts with absolute discounting; contexts and pairs are sorted hashes or numbers."""

    def __init__(self, context: np.ndarray, key: np.ndarray, times: np.ndarray):
        self.keys, at, inverse = np.unique(key, return_index=True, return_inverse=True)
        n = np.bincount(inverse, times)
        self.contexts, which = np.unique(context[at], return_inverse=True)
        seen = np.bincount(which, n)
        self.share = ((n - DISCOUNT) / seen[which]).astype(np.float32)
        self.back = (DISCOUNT * np.bincount(which) / seen).astype(np.float32)

    @staticmethod
    def _at(table: np.ndarray, values: np.ndarray, x: np.ndarray, absent: float) -> np.ndarray:
        if not len(table):
            return np.full(len(x), absent, np.float32)
        at = np.minimum(np.searchsorted(table, x), len(table) - 1)
        return np.where(table[at] == x, values[at], np.float32(absent))

    def __call__(self, context: np.ndarray, key: np.ndarray, lower: np.ndarray) -> np.ndarray:
        return self._at(self.keys, self.share, key, 0) + self._at(self.contexts, self.back, context, 1) * lower


#: Stands for a word's end among the subwords.
WORD_END = VOCABULARY
_WIDTH = VOCABULARY + 1


def _transitions(s: Slice) -> tuple[np.ndarray, ...]:
    """Of the distinct words, for every subword but the first and for the word's end: hash of the word so far, last subword, next, word."""
    n = np.diff(s.cuts)
    mass = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(s.ids.astype(np.uint64) + np.uint64(1)) * powers.to(len(s.ids) + 1).up[: len(s.ids)], dtype=np.uint64)])
    word = np.repeat(np.arange(len(n)), n)
    begin = s.cuts[word]
    sofar = mixed((mass[1:] - mass[begin]) * powers.down[begin])
    following = np.append(s.ids[1:], 0).astype(np.int64)
    following[s.cuts[1:] - 1] = WORD_END
    return sofar, s.ids.astype(np.int64), following, word


def _inside(s: Slice) -> tuple[np.ndarray, ...]:
    """Distinct (word so far, next) pairs: names, the words so far, last subword and next as one number; each transition's pair and word."""
    sofar, last, following, word = s.transitions
    key, at, which = distinct(mixed(sofar * ODD + following.astype(np.uint64)))
    return key, sofar[at], (last * _WIDTH + following)[at], which, word


def _by_word(s: Slice, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the transitions' probabilities, those of the distinct words' subwords (1 for the first) and ends."""
    inner = np.concatenate([np.ones(1, np.float32), p[:-1]])
    inner[s.cuts[:-1]] = 1
    return inner, p[s.cuts[1:] - 1]


def _heads(s: Slice) -> np.ndarray:
    """Of every word and text's end, the first subword of the word before and its own, as one number."""
    heads = np.insert(s.ids[s.cuts[:-1]][s.word].astype(np.int64), s.edges[1:], END)
    return np.insert(heads[:-1], 0, END) * _WIDTH + heads if len(heads) else heads


def _singles(inner: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of subwords inside words and at their beginnings, from counts."""
    starts = np.append(_starts_word(), False)
    inner = np.where(starts, 0, inner + 0.5)
    starts[END] = True
    head = np.where(starts, head + 0.5, 0)
    return (inner / inner.sum()).astype(np.float32), (head / head.sum()).astype(np.float32)


def _backed(n: np.ndarray, of: np.ndarray, contexts: int) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs that occur n times, each behind the context `of`: shares, and weights of what they back off to."""
    seen, kinds = np.bincount(of, n, contexts), np.bincount(of, n > 0, contexts)
    share = np.maximum(n - DISCOUNT, 0) / np.maximum(seen, 1)[of]
    return share, np.where(seen > 0, DISCOUNT * kinds / np.maximum(seen, 1), 1)[of]


class Prior:
    """Subword probabilities from words alone, of slices in memory; a subword pair inside words counts once for each word so far."""

    def __init__(self, slices: Iterator[Slice]):
        sofar, pair_in_word, pair_last, first, times_in, times_first = [], [], [], [], [], []
        for s in slices:
            times = np.bincount(s.word, minlength=len(s.names))
            key, a, pair, which, word = s.inside
            sofar.append(a)
            pair_in_word.append(key)
            pair_last.append(pair)
            times_in.append(np.bincount(which, times[word], len(key)))
            pair, n = np.unique(_heads(s), return_counts=True)
            first.append(pair)
            times_first.append(n)
        join = lambda x, t=np.int64: np.concatenate([np.zeros(0, t), *x])
        key = join(pair_in_word, np.uint64)
        self.inside = Bigrams(join(sofar, np.uint64), key, join(times_in))
        new = join(pair_last)[np.unique(key, return_index=True)[1]]
        self.last = Bigrams(new // _WIDTH, new, np.ones(len(new)))
        pair, n = join(first), join(times_first)
        self.heads = Bigrams(pair // _WIDTH, pair, n)
        self.inner_single, self.head_single = _singles(np.bincount(new % _WIDTH, minlength=_WIDTH), np.bincount(pair % _WIDTH, n, _WIDTH))

    def words(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Of the distinct words: each subword's probability given the word so far (1 for the first); each word's end's."""
        if not len(s.ids):
            return np.ones(0, np.float32), np.ones(0, np.float32)
        sofar, last, following, _ = s.transitions
        p = self.last(last, last * _WIDTH + following, self.inner_single[following])
        p = self.inside(sofar, mixed(sofar * ODD + following.astype(np.uint64)), p)
        return _by_word(s, p)

    def first(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        context, token = context.astype(np.int64), token.astype(np.int64)
        return self.heads(context, context * _WIDTH + token, self.head_single[token])


@dataclass
class Sums:
    """By subword, of pairs in all training documents: how often it comes first, with how many others, how often second."""

    seen: np.ndarray
    kinds: np.ndarray
    second: np.ndarray
    n: np.ndarray | None = None  # of each pair, where they are at hand

    @staticmethod
    def of(pair: np.ndarray, n: np.ndarray) -> Sums:
        """Of distinct pairs that occur n times."""
        one, two = pair // _WIDTH, pair % _WIDTH
        return Sums(np.bincount(one, n, _WIDTH), np.bincount(one, n > 0, _WIDTH), np.bincount(two, n, _WIDTH), n)

    def share(self, pair: np.ndarray, n: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Bigrams' probability of pairs that occur n times."""
        seen, kinds = self.seen[pair // _WIDTH], self.kinds[pair // _WIDTH]
        found = (np.maximum(n - DISCOUNT, 0) + DISCOUNT * kinds * lower) / np.maximum(seen, 1)
        return np.where(seen > 0, found, lower).astype(np.float32)


@dataclass
class Counted:
    """Prior of one slice, from the counts that the buckets gave back."""

    last: Sums
    heads: Sums
    singles: tuple[np.ndarray, np.ndarray]
    got: dict[tuple[int, int], list[bytes]]  # by kind and bucket
    buckets: int

    def _values(self, kind: int, key: np.ndarray, t: str = "<u4", part: int = 0) -> np.ndarray:
        out, order, cuts = np.zeros(len(key), t), *_dealt(key, self.buckets)
        for b in range(self.buckets):
            if cuts[b] < cuts[b + 1]:
                out[order[cuts[b] : cuts[b + 1]]] = _unzip(self.got[kind, b][part], t)
        return out

    def words(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        if not len(s.ids):
            return np.ones(0, np.float32), np.ones(0, np.float32)
        _, sofar, pair, which, _ = s.inside
        lasts, _, at = distinct(pair)
        lower = self.last.share(lasts, self._values(LAST, lasts), self.singles[0][lasts % _WIDTH])[at]
        p = (self._values(INSIDE, sofar, "<f4", 0) + self._values(INSIDE, sofar, "<f4", 1) * lower)[which]
        return _by_word(s, p)

    def first(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        pair, _, at = distinct(context.astype(np.int64) * _WIDTH + token)
        return self.heads.share(pair, self._values(HEADS, pair), self.singles[1][pair % _WIDTH])[at]


class Halves:
    """Prior of each half (0, 1) of a slice's texts from the other half's; other texts count nowhere.  Words are numbered as in twice()."""

    def __init__(self, s: Slice, half: np.ndarray):
        self.whole, self.words_half, self.heads_half = s, np.repeat(half, np.diff(s.edges)), np.repeat(half, np.diff(s.edges) + 1)

    def twice(self) -> Slice:
        """The slice with its distinct words once for each half."""
        s = self.whole
        return Slice(np.tile(s.names, 2), s.word + len(s.names) * (self.words_half == 1), s.edges, np.tile(s.ids, 2), np.append(s.cuts[:-1], s.cuts + len(s.ids)))

    def words(self, _: Slice) -> tuple[np.ndarray, np.ndarray]:
        s = self.whole
        if not len(s.ids):
            return np.ones(0, np.float32), np.ones(0, np.float32)
        key, sofar, pair, which, word = s.inside
        (context, _, of), (lasts, _, at) = distinct(sofar), distinct(pair)
        found = []
        for other in (1, 0):
            times = np.bincount(s.word[self.words_half == other], minlength=len(s.names))
            n = np.bincount(which, times[word], len(key))
            share, back = _backed(n, of, len(context))
            last = Sums.of(lasts, np.bincount(at, n > 0, len(lasts)))
            lower = last.share(lasts, last.n, _singles(last.second, last.second)[0][lasts % _WIDTH])
            found.append(_by_word(s, (share + back * lower[at])[which].astype(np.float32)))
        return np.append(found[0][0], found[1][0]), np.append(found[0][1], found[1][1])

    def first(self, context: np.ndarray, token: np.ndarray) -> np.ndarray:
        pair, _, at = self.whole.heads  # of the same words and ends in the same order
        chance = np.ones(len(at), np.float32)
        for own, other in ((0, 1), (1, 0)):
            heads = Sums.of(pair, np.bincount(at[self.heads_half == other], minlength=len(pair)))
            mine = self.heads_half == own
            chance[mine] = heads.share(pair, heads.n, _singles(heads.second, heads.second)[1][pair % _WIDTH])[at[mine]]
        return chance


@dataclass
class Attention:
    query: np.ndarray
    key: np.ndarray
    distance: np.ndarray  # by distance, from 1
    sink: np.ndarray  # by the token before

    @staticmethod
    def new(seed: int = 5) -> Attention:
        rng = np.random.default_rng(seed)
        same = rng.normal(0, 0.5, (VOCABULARY, DIM)).astype(np.float32)
        return Attention(same.copy(), same, np.zeros(2 * BLOCK, np.float32), np.full(VOCABULARY, 4.0, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.query, self.key, self.distance, self.sink]


_Q, _J = np.arange(BLOCK)[:, None], np.arange(2 * BLOCK)[None, :]
_BEFORE = _Q + BLOCK > _J
_DISTANCE = np.where(_BEFORE, _Q + BLOCK - _J, 0)
_MASK = np.where(_BEFORE, 0, -np.inf).astype(np.float32)


def _attend(model: Attention, before: np.ndarray, token: np.ndarray, valid: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, ...]:
    """before, token: windows x 2 blocks; the second block is scored.  valid: whether a window has its first block; prior: windows x block."""
    asks = before[:, BLOCK:]
    q, k, sink = model.query.take(asks, axis=0), model.key.take(before, axis=0), model.sink.take(asks)
    z = q @ np.ascontiguousarray(k.transpose(0, 2, 1))
    z += model.distance[_DISTANCE] + _MASK
    z[~valid, :, :BLOCK] = -np.inf
    if max(z.max(), sink.max()) > 40 or sink.min() < -40:  # beyond what exp() takes: as if the largest were 0
        top = np.maximum(z.max(axis=2), sink)
        z -= top[:, :, None]
        sink = sink - top
    np.exp(z, out=z)
    rest, ones = np.exp(sink), np.ones(2 * BLOCK, np.float32)
    total = (z.reshape(-1, 2 * BLOCK) @ ones).reshape(rest.shape) + rest
    copied = (token[:, BLOCK:, None] == token[:, None, :]).astype(np.float32)
    copied *= z
    return ((copied.reshape(-1, 2 * BLOCK) @ ones).reshape(rest.shape) + rest * prior) / total, z, rest, total, copied, q, k


def _blocks(ids: np.ndarray, chance: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
    """Streams in blocks: token and its predecessor (blocks x BLOCK, filled up with END), places filled, whether a block begins its text, its text, the prior."""
    length = np.diff(begin)
    n = -(-length // BLOCK)
    first = np.concatenate([[0], np.cumsum(n)])
    text = np.repeat(np.arange(len(length)), length)
    at = first[text] * BLOCK + np.arange(len(ids)) - begin[text]
    token, before = np.full(first[-1] * BLOCK, END, np.uint16), np.full(first[-1] * BLOCK, END, np.int32)
    filled = np.zeros(first[-1] * BLOCK, bool)
    token[at], filled[at] = ids, True
    previous = np.concatenate([[END], ids[:-1]]).astype(np.int32)
    previous[begin[:-1]] = END
    before[at] = previous
    starts = np.zeros(first[-1], bool)
    starts[first[:-1]] = True
    prior = np.ones(first[-1] * BLOCK, np.float32)
    prior[at] = chance
    shape = (-1, BLOCK)
    return token.reshape(shape), before.reshape(shape), filled.reshape(shape), starts, np.repeat(np.arange(len(length)), n), prior.reshape(shape)


def _windows(a: np.ndarray, i: int, j: int) -> np.ndarray:
    """Blocks i to j, each behind the block before it."""
    ahead = a[i - 1 : j - 1] if i else np.concatenate([a[:1], a[: j - 1]])
    return np.concatenate([ahead, a[i:j]], axis=1)


@dataclass
class Model:
    attention: Attention
    prior: Prior | Counted

    def score(self, s: Slice) -> np.ndarray:
        """log10 probability of each text, its end included."""
        ids, chance, begin = stream(s, self.prior)
        token, before, filled, starts, text, prior = _blocks(ids, chance, begin)
        logs = np.empty(len(token))
        for i in range(0, len(token), NEAR):
            j = min(len(token), i + NEAR)
            p = _attend(self.attention, _windows(before, i, j), _windows(token, i, j), ~starts[i:j], prior[i:j])[0]
            logs[i:j] = np.where(filled[i:j], np.log10(np.maximum(p, 1e-30)), 0).sum(axis=1)
        return np.bincount(text, logs, len(begin) - 1)


def _slices(texts: list[str]) -> Iterator[Slice]:
    return (sliced(texts[i : i + 256]) for i in range(0, len(texts), 256))


def fit(texts: list[str], epochs: int = 2) -> Model:
    """Attention beside a prior that counts these texts, all in memory."""
    return Model(attention(texts, epochs), Prior(_slices(texts)))


def attention(texts: list[str], epochs: int = 2) -> Attention:
    """Attention that learned from all of these texts in one process."""
    learner = Learner()
    for i in range(0, len(texts), SLICE):
        s = sliced(texts[i : i + SLICE])
        learner.learn(s, np.ones(len(s.edges) - 1, bool), epochs)
    return learner.model


class Learner:
    """Attention as it learns: Adam on the rows of the tokens that a batch holds."""

    def __init__(self, seed: int = 5):
        self.model, self.rng, self.steps = Attention.new(seed), np.random.default_rng(3), 0
        self.moments = [(np.zeros_like(x), np.zeros_like(x)) for x in self.model.parts()]
        #: How often each token was seen; at the end the blocks.
        self.seen = np.zeros(VOCABULARY + 1, np.int64)

    def learn(self, s: Slice, train: np.ndarray, epochs: int = 1) -> None:
        """Learn from every text that trains; each half of them has its prior from the other half."""
        half = np.full(len(train), 2)
        half[train] = np.arange(train.sum()) % 2
        prior = Halves(s, half)
        *blocks, of, guesses = _blocks(*stream(prior.twice(), prior))
        for own in range(2):
            mine = np.flatnonzero(half[of] == own)
            if len(mine):
                token, before, filled, starts, guess = (x.take(mine, axis=0) for x in (*blocks, guesses))
                self.seen[:-1] += np.bincount(before[filled], minlength=VOCABULARY)
                self.seen[-1] += len(token)
                for _ in range(epochs):
                    for at in np.array_split(self.rng.permutation(len(token)), -(-len(token) // BATCH)):
                        ahead = np.maximum(at - 1, 0)  # a text's first block has none before it
                        b, x = (np.concatenate([a.take(ahead, axis=0), a.take(at, axis=0)], axis=1) for a in (before, token))
                        self._step(b, x, ~starts[at], filled[at], guess[at])

    def _step(self, b: np.ndarray, x: np.ndarray, valid: np.ndarray, filled: np.ndarray, guess: np.ndarray) -> None:
        asks = b[:, BLOCK:].ravel()
        dq, dk, dsink, near = np.empty((len(b), BLOCK, DIM), np.float32), np.empty((*b.shape, DIM), np.float32), np.empty((len(b), BLOCK), np.float32), 0
        for i in range(0, len(b), NEAR):
            part = slice(i, i + NEAR)
            chance, z, rest, total, dz, q, k = _attend(self.model, b[part], x[part], valid[part], guess[part])
            weight = filled[part] / (np.maximum(chance, 1e-30) * total) / len(b)
            z *= chance[:, :, None]
            dz -= z
            dz *= weight[:, :, None]
            np.matmul(dz, k, out=dq[part])
            np.matmul(dz.transpose(0, 2, 1), q, out=dk[part])
            dsink[part] = rest * (guess[part] - chance) * weight
            near = near + dz.sum(axis=0)
        self.steps += 1
        rows, g = _row_sums(asks, dq.reshape(-1, DIM))
        self._move(0, rows, g)
        self._move(3, rows, np.bincount(asks, dsink.ravel())[rows])
        self._move(1, *_row_sums(b.ravel(), dk.reshape(-1, DIM)))
        self._move(2, slice(None), np.bincount(_DISTANCE.ravel(), near.ravel(), 2 * BLOCK))

    def _move(self, part: int, rows: np.ndarray | slice, g: np.ndarray) -> None:
        y, (m, v) = self.model.parts()[part], self.moments[part]
        a, b = (x[rows] if isinstance(rows, slice) else x.take(rows, axis=0) for x in (m, v))
        a = (a + 0.1 * (g - a)).astype(np.float32)
        b = (b + 0.01 * (g * g - b)).astype(np.float32)
        m[rows], v[rows] = a, b
        y[rows] += (0.03 * (a / (1 - 0.9**self.steps)) / (np.sqrt(b / (1 - 0.99**self.steps)) + 1e-8)).astype(np.float32)

    def learned(self) -> pa.RecordBatch:
        """By token: how often it was seen, and so many times what its sink, query and key learned; distances as token -1."""
        new, old = self.model.parts(), Attention.new().parts()
        sink, query, key = (new[i] - old[i] for i in (3, 0, 1))
        rows = np.flatnonzero(self.seen[:-1])
        n = self.seen[rows].astype(np.float64)
        distance = (new[2] - old[2]) * float(self.seen[-1])
        of = lambda a, last: pa.array(np.append(a, last), pa.float64())
        columns = [pa.array(np.append(rows, -1), pa.int32()), of(n, self.seen[-1]), of(sink[rows] * n, 0)]
        columns += [of(query[rows, i] * n, distance[i]) for i in range(DIM)] + [of(key[rows, i] * n, distance[BLOCK + i]) for i in range(DIM)]
        return pa.RecordBatch.from_arrays(columns, names=_LEARNED)


_LEARNED = ["token", "n", "sink", *(f"q{i}" for i in range(DIM)), *(f"k{i}" for i in range(DIM))]
_LEARNED_SCHEMA = "token int, " + ", ".join(f"{c} double" for c in _LEARNED[1:])


def _row_sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows (subwords) and the sums of their values."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")  # of 16 bits: numpy counts instead of comparing
    rows = rows.take(order)
    first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    pairs = values.take(order, axis=0).view(np.complex64)  # two columns added at once
    return rows[first], np.add.reduceat(pairs, first, axis=0).view(np.float32)


def _bounded(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most SLICE documents and about CHARACTERS of text."""
    for b in slices_of(batches, SLICE):
        part = np.cumsum([len(x or "") for x in b.column(text).to_pylist()]) // CHARACTERS
        for k in np.unique(part):
            rows = np.flatnonzero(part == k)
            yield b.slice(int(rows[0]), len(rows))


def trained(docs: DataFrame) -> Attention:
    """Attention weights from all documents that are not held out; every task starts from the same weights."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Learner()
        for b in _bounded(batches, 0):
            learner.learn(sliced([x or "" for x in b.column(0).to_pylist()]), ~b.column(1).to_numpy(zero_copy_only=False).astype(bool))
        if learner.steps:
            yield learner.learned()

    return _averaged(docs.select("text", held_out(F.col("doc_id"), 5, 1).alias("held_out")).mapInArrow(learn, _LEARNED_SCHEMA))


def _averaged(parts: DataFrame) -> Attention:
    """The mean of what the tasks learned."""
    rows = parts.groupBy("token").agg(*(F.sum(c).alias(c) for c in _LEARNED[1:])).toArrow()  # at most a row a subword
    token, n, sink, *rest = (rows.column(c).to_numpy() for c in _LEARNED)
    model = Attention.new()
    if len(token):
        query, key = (np.stack(x, axis=1) / n[:, None] for x in (rest[:DIM], rest[DIM:]))
        of, distances = token >= 0, np.flatnonzero(token < 0)[0]
        model.query[token[of]] += query[of].astype(np.float32)
        model.key[token[of]] += key[of].astype(np.float32)
        model.sink[token[of]] += (sink / n)[of].astype(np.float32)
        model.distance[:] += np.append(query[distances], key[distances]).astype(np.float32)
    return model


def _packed(s: Slice, train: np.ndarray, buckets: int) -> Iterator[tuple]:
    """By bucket: names, pairs of each, the pairs' texts and counts (at most 255; more take several pairs), which texts train."""
    n = len(train)
    text = np.repeat(np.arange(n), np.diff(s.edges))
    names = np.append(s.names, END_WORD)
    pair, times = np.unique(np.concatenate([s.word * n + text, len(s.names) * n + np.arange(n)]), return_counts=True)
    more = (times - 1) // 255
    if more.any():
        pair, last = np.repeat(pair, more + 1), np.cumsum(more + 1) - 1
        whole = np.full(len(pair), 255)
        whole[last] = times - 255 * more
        times = whole
    bucket = (mixed(names) % np.uint64(buckets)).astype(np.int64)
    of = pair // n
    order = ordered(bucket[of])
    cuts = np.searchsorted(bucket[of][order], np.arange(buckets + 1))
    flags = np.packbits(train).tobytes()
    for b in range(buckets):
        mine = order[cuts[b] : cuts[b + 1]]
        if len(mine):
            which, count = np.unique(of[mine], return_counts=True)
            yield b, names[which].tobytes(), count.astype("<u4").tobytes(), (pair[mine] % n).astype("<u2").tobytes(), times[mine].astype(np.uint8).tobytes(), flags


#: Parts in which rows are dealt out one after another, so that only a part of them is in shuffle files at once.
ROUNDS = 4
#: What a packed row is about: words of the base; pairs inside words; first subwords of neighbouring words; last subword and next; a slice's texts;
#: what a task's attention learned.  Pairs inside words that are yet to be counted: ASKED and the following, one for each part.
BASE, INSIDE, HEADS, LAST, TEXTS, LEARNED, ASKED = range(7)


def _zip(x: np.ndarray) -> bytes:
    return len(data := x.tobytes()).to_bytes(4, "little") + (pa.compress(data, codec="zstd", asbytes=True) if data else b"")


def _unzip(x: bytes, t: str | type) -> np.ndarray:
    n = int.from_bytes(x[:4], "little")
    return np.frombuffer(pa.decompress(x[4:], n, codec="zstd", asbytes=True) if n else b"", t)


def _dealt(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys by bucket, and where each bucket's begin."""
    bucket = (mixed(key.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = ordered(bucket)
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _asked(s: Slice, train: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Kind, bucket, then by kind: words so far, pairs, training counts; pairs, training counts; pairs; the slice itself."""
    words = np.diff(s.edges)
    times = np.bincount(s.word, np.repeat(train, words), len(s.names))
    key, sofar, pair, which, word = s.inside
    n = np.bincount(which, times[word], len(key)).astype("<u4")
    order, cuts = _dealt(sofar, buckets)
    for b in np.flatnonzero(np.diff(cuts)):
        mine = order[cuts[b] : cuts[b + 1]]
        yield ASKED + int(b) % ROUNDS, int(b), _zip(sofar[mine]), _zip(pair[mine].astype("<u4")), _zip(n[mine]), None, None
    heads, _, at = s.heads
    for kind, pairs, n in ((HEADS, heads, np.bincount(at, np.repeat(train, words + 1), len(heads)).astype("<u4")), (LAST, np.unique(pair), None)):
        order, cuts = _dealt(pairs, buckets)
        for b in np.flatnonzero(np.diff(cuts)):
            mine = order[cuts[b] : cuts[b + 1]]
            yield kind, int(b), _steps(pairs[mine]), None if n is None else _zip(n[mine]), None, None, None
    word = s.word.astype("<u4").view("<u2").reshape(-1, 2).T  # low halves, then high ones
    yield TEXTS, None, _zip(word), _zip(s.edges.astype("<u4")), _zip(s.ids.astype("<u4")), _zip(s.cuts.astype("<u4")), np.packbits(train).tobytes()


def _unpacked(row: dict) -> tuple[Slice, np.ndarray]:
    """The slice of a row of texts, its words named by their subwords, and which of its texts train."""
    edges, ids, cuts = (_unzip(row[c], "<u4").astype(np.int64) for c in "bcd")
    low, high = _unzip(row["a"], "<u2").reshape(2, -1).astype(np.int64)
    s = Slice(np.zeros(0, np.uint64), low + (high << 16), edges, ids.astype(np.int32), cuts)
    if len(ids):
        s.names = s.transitions[0][cuts[1:] - 1]  # a word is all of its subwords
    return s, np.unpackbits(np.frombuffer(row["e"], np.uint8), count=len(edges) - 1).astype(bool)


def _steps(pairs: np.ndarray) -> bytes:
    """Rising numbers below 2**32 as differences, which compress better."""
    return _zip(np.diff(pairs, prepend=0).astype("<u4"))


def _within(rows: pa.Table, buckets: int) -> pa.Table:
    """One bucket of pairs inside words: to each slice its pairs' shares and back-off weights; and how many words so far hold each (last, next)."""
    get = lambda c, t: [_unzip(x, t) for x in rows.column(c).to_pylist()]
    sofar, parts = np.concatenate(get("a", np.uint64)), get("b", "<u4")
    pair, n = np.concatenate(parts).astype(np.int64), np.concatenate(get("c", "<u4")).astype(np.int64)
    _, at, which = distinct(mixed(sofar * ODD + (pair % _WIDTH).astype(np.uint64)))
    n = np.bincount(which, n, len(at))
    context, _, of = distinct(sofar[at])
    share, back = (x.astype("<f4")[which] for x in _backed(n, of, len(context)))
    out, i = [], 0
    bucket = rows.column("bucket")[0].as_py()
    for slice_, x in zip(rows.column("slice").to_pylist(), parts, strict=True):
        out.append((slice_, INSIDE, bucket, _zip(share[i : i + len(x)]), _zip(back[i : i + len(x)]), None, None, None))
        i += len(x)
    pair, n = np.unique(pair[at][n > 0], return_counts=True)
    order, cuts = _dealt(pair, buckets)
    for b in np.flatnonzero(np.diff(cuts)):
        mine = order[cuts[b] : cuts[b + 1]]
        out.append((None, LAST, int(b), _steps(pair[mine]), _zip(n[mine].astype("<u4")), None, None, None))
    freed()
    return _table(out, _PACKED)


def _pairs(rows: pa.Table) -> pa.Table:
    """One bucket of pairs of one kind: to each slice its pairs' counts; by subword the bucket's part of Sums."""
    parts = [np.cumsum(_unzip(x, "<u4"), dtype=np.int64) for x in rows.column("a").to_pylist()]
    n = np.concatenate([np.zeros(len(x), "<u4") if y is None else _unzip(y, "<u4") for x, y in zip(parts, rows.column("b").to_pylist(), strict=True)])
    pair, _, which = distinct(np.concatenate(parts))
    total = np.bincount(which, n, len(pair)).astype(np.int64)
    mine, i, out = total[which].astype("<u4"), 0, []
    kind, bucket = (rows.column(c)[0].as_py() for c in ("kind", "bucket"))
    for slice_, x in zip(rows.column("slice").to_pylist(), parts, strict=True):
        if slice_ is not None:
            out.append((slice_, kind, bucket, _zip(mine[i : i + len(x)]), *[None] * 8))
        i += len(x)
    pair, total = pair[total > 0], total[total > 0]
    token, _, at = distinct(np.concatenate([pair // _WIDTH, pair % _WIDTH]))
    one, two = at[: len(pair)], at[len(pair) :]
    sums = zip(token.tolist(), *(np.bincount(x, w, len(token)).astype(np.int64).tolist() for x, w in ((one, total), (one, None), (two, total))), strict=True)
    out += [(None, kind, bucket, *[None] * 5, *x) for x in sums]
    freed()
    return _table(out, [*_PACKED, *_SUMS])


_WORDS = [("names", pa.binary()), ("pairs", pa.binary()), ("texts", pa.binary()), ("times", pa.binary()), ("flags", pa.binary())]
_PACKED = [("slice", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("d", pa.binary()), ("e", pa.binary())]
_SUMS = [("token", pa.int32()), ("seen", pa.int64()), ("kinds", pa.int64()), ("second", pa.int64())]
_TEXTS = [("text", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64())]
_PACKED_SCHEMA = "slice long, kind int, bucket int, a binary, b binary, c binary, d binary, e binary"


def _table(rows: list[tuple], columns: list[tuple]) -> pa.Table:
    cols = list(zip(*rows, strict=True)) or [()] * len(columns)
    return pa.table([pa.array(c, t) for c, (_, t) in zip(cols, columns, strict=True)], names=[n for n, _ in columns])


def _count(rows: pa.Table) -> pa.Table:
    """One bucket: each word's training count; by slice the sums of log10(count + 0.5) and of known tokens by text."""
    get = lambda c, t: [np.frombuffer(x, t) for x in rows.column(c).to_pylist()]
    names, pairs, texts, times = get("names", np.uint64), get("pairs", "<u4"), get("texts", "<u2"), get("times", np.uint8)
    train = [np.unpackbits(f).astype(bool) for f in get("flags", np.uint8)]
    word = distinct(np.concatenate(names))[2]
    of = np.repeat(word, np.concatenate(pairs))
    times_all = np.concatenate(times).astype(np.int64)
    trains = np.concatenate([f[t] for f, t in zip(train, texts, strict=True)])
    count = np.bincount(of, times_all * trains, int(word.max()) + 1)
    log, known = np.log10(count + 0.5), count > 0
    out, at = [], 0
    for slice_, t, x in zip(rows.column("slice").to_pylist(), texts, times, strict=True):
        mine = of[at : at + len(t)]
        at += len(t)
        which = np.flatnonzero(np.bincount(t))
        out.append((slice_, which.astype("<u2").tobytes(), np.bincount(t, x * log[mine])[which].tobytes(), np.bincount(t, x * known[mine])[which].astype(np.int64).tobytes(), None, None))
    out.append((None, None, None, None, int(count.sum()), int(known.sum())))
    cols = list(zip(*out, strict=True))
    freed()
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["slice", "texts", "logs", "known", "n", "v"])


def _texts(rows: pa.Table, attention: Attention, last: Sums, heads: Sums, singles: tuple, buckets: int) -> pa.Table:
    """One slice: its texts' scores, and the sums of the base's buckets by text."""
    kinds = rows.column("kind")
    base, (whole,) = rows.filter(pc.equal(kinds, BASE)), rows.filter(pc.equal(kinds, TEXTS)).select(["a", "b", "c", "d", "e"]).to_pylist()
    got = {(k, b): [x, y] for k, b, x, y in zip(*(rows.column(c).to_pylist() for c in ("kind", "bucket", "a", "b")), strict=True) if k in (INSIDE, HEADS, LAST)}
    score = Model(attention, Counted(last, heads, singles, got, buckets)).score(_unpacked(whole)[0])
    texts, logs, known = (np.concatenate([np.frombuffer(x, t) for x in base.column(c).to_pylist()]) for c, t in (("a", "<u2"), ("b", np.float64), ("c", np.int64)))
    n = len(score)
    del got, whole
    freed()
    return pa.table({"slice": pa.array([rows.column("slice")[0].as_py()] * n, pa.int64()), "text": pa.array(np.arange(n, dtype=np.int32)), "logs": pa.array(np.bincount(texts, logs, n)), "n_known": pa.array(np.bincount(texts, known, n).astype(np.int64)), "score": pa.array(score)})


def scores(docs: DataFrame, attention: Attention | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    A null text counts as empty (its end is its only token); a row without doc_id is not
    held out and counts for base and prior; repeated rows stay and count as often; other
    columns are ignored; an empty table stays empty.
    """
    spark, learns = docs.sparkSession, attention is None
    size = docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    buckets = max(shuffle_partitions(spark), -(-size // BUCKET))
    columns = [*_PACKED, *_TEXTS]
    schema = _PACKED_SCHEMA + ", text int, doc_id long, held_out boolean, n_tokens long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, learner = TaskContext.get().partitionId() << 32, Learner() if learns else None
        for b in _bounded(batches, 1):
            s = sliced([t or "" for t in b.column(1).to_pylist()])
            out = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            rows = [(number, kind, bucket, *r, *[None] * len(_TEXTS)) for kind, bucket, *r in _asked(s, ~out, buckets)]
            tokens = (np.diff(s.edges) + 1).tolist()
            rows += [(number, *[None] * (len(_PACKED) - 1), *r) for r in zip(range(b.num_rows), b.column(0).to_pylist(), out.tolist(), tokens, strict=True)]
            number += 1
            yield from _table(rows, columns).to_batches()
            del rows
            if learns:
                learner.learn(s, ~out)
        if learns and learner.steps:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, (found := learner.learned()).schema) as w:
                w.write_batch(found)
            yield from _table([(None, LEARNED, None, sink.getvalue().to_pybytes(), *[None] * (4 + len(_TEXTS)))], columns).to_batches()

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0):
                yield from pa.ipc.open_stream(x.as_buffer())

    def in_rounds(make: Callable[[int], DataFrame], label: str, done: Callable[[int], None] = lambda r: None) -> DataFrame:
        """make() of each part of the rows, written one after another."""
        parts = []
        for r in range(ROUNDS):
            parts.append(written(make(r), label))
            done(r)
        return reduce(DataFrame.unionByName, parts)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id"), 5, 1).alias("held_out"))
    found = written(slim.mapInArrow(read, schema), "words", by="kind")
    rows = found.select(*[c for c, _ in _PACKED])
    if learns:
        attention = _averaged(rows.where(F.col("kind") == LEARNED).select("a").mapInArrow(learned, _LEARNED_SCHEMA))
    inside = in_rounds(lambda r: rows.where(F.col("kind") == ASKED + r).groupBy("bucket").applyInArrow(lambda t: _within(t, buckets), _PACKED_SCHEMA), "inside", lambda r: dropped(found, part=f"kind={ASKED + r}"))
    pairs = rows.where(F.col("kind").isin(HEADS, LAST)).unionByName(inside.where(F.col("kind") == LAST))
    pairs = written(pairs.groupBy("kind", "bucket").applyInArrow(_pairs, _PACKED_SCHEMA + ", token int, seen long, kinds long, second long"), "pairs")
    sums = {kind: Sums(*(np.zeros(_WIDTH) for _ in range(3))) for kind in (HEADS, LAST)}
    for r in pairs.where("token IS NOT NULL").groupBy("kind", "token").agg(*(F.sum(c).alias(c) for c, _ in _SUMS[1:])).collect():  # at most two rows a subword
        x = sums[r["kind"]]
        x.seen[r["token"]], x.kinds[r["token"]], x.second[r["token"]] = r["seen"], r["kinds"], r["second"]
    for kind in (HEADS, LAST):
        dropped(found, part=f"kind={kind}")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches, 1):
            (row,) = b.to_pylist()
            yield from _table([(row["slice"], *r) for r in _packed(*_unpacked(row), buckets)], [_PACKED[0], _PACKED[2], *_WORDS]).to_batches()

    whole = rows.where(F.col("kind") == TEXTS)
    packed = whole.mapInArrow(words, "slice long, bucket int, names binary, pairs binary, texts binary, times binary, flags binary")
    counted = written(packed.groupBy("bucket").applyInArrow(_count, "slice long, texts binary, logs binary, known binary, n long, v long"), "counted")
    total = counted.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = total["n"] or 0, total["v"] or 0
    shared = spark.sparkContext.broadcast((attention, sums[LAST], sums[HEADS], _singles(sums[LAST].second, sums[HEADS].second)))

    none = F.lit(None).cast("binary")
    base_rows = counted.where("slice IS NOT NULL").select("slice", F.lit(BASE).alias("kind"), F.lit(None).cast("int").alias("bucket"), F.col("texts").alias("a"), F.col("logs").alias("b"), F.col("known").alias("c"), none.alias("d"), none.alias("e"))
    all_rows = base_rows.unionByName(whole).unionByName(inside.where(F.col("kind") == INSIDE)).unionByName(pairs.where("slice IS NOT NULL").select(*[c for c, _ in _PACKED]))
    scored = in_rounds(lambda r: all_rows.where(F.pmod(F.xxhash64("slice"), F.lit(ROUNDS)) == r).groupBy("slice").applyInArrow(lambda t: _texts(t, *shared.value, buckets), "slice long, text int, logs double, n_known long, score double"), "scored")
    texts = found.where("kind IS NULL AND text IS NOT NULL").select("slice", *[c for c, _ in _TEXTS])
    base = F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(n + 0.5 * (v + 1))))
    return texts.join(scored, ["slice", "text"]).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")
