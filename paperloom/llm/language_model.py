"""Scoring by a gated recurrent language model with a class-factored softmax.

Tokens are the words of a text and one end. Counts come from all training texts.
The most frequent words have places in classes of the output: a token's
probability is its class's, given the recurrent state, times its own in the class.
All other words fall into classes by their last letters; in those the state gives
the class and the corpus counts give the word, so every word has a probability.

Training goes over all training texts once. A hash of id and text, and nothing
else, deals them to parts and rounds, and in a part orders them; so the model is a
property of the table and not of the cluster. In a round each part runs truncated
backpropagation over its texts of that round from the same weights, and the weights
are averaged, weighted by tokens, in a tree of fan-in ``FAN``; the next round starts
from the average. The first start is the unigram model, so what training adds is
context. A lane whose text has ended takes the next one from an empty state, and
where few lanes are left the windows are longer. Scoring carries the state over all windows of a text, so a text's
log-likelihood covers it from its first word to its end.

What is learned grows with the input: counts cover all words; the words with places
of their own in the output grow with the square root of the vocabulary; the number
of parts and the steps in each grow with the square root of the tokens, the rounds
with their logarithm.

Size: word counts are shuffled by a 64-bit hash of the word. The words in the
broadcast table number at most ``TABLE``; the counts of all others are joined in.
What reaches the driver is that table and at most ``FAN`` weight vectors a round.

Edge cases: a null or empty text is one end token; repeated rows are scored alike
and train as often; without training texts every count is 0 and the model is the
start; a null id counts as the empty string in the split. Texts whose hashes tie
have the same id and text, so their order does not matter. Arithmetic is in 32 bits
over texts in a fixed order; sums are in 64.
"""

from __future__ import annotations

import copy
import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import id_text, settled, table

HIDDEN, RARE = 8, 16
PLACES = 1024  # words with places at least; enough for a vocabulary of some 4 million
START = PLACES + RARE  # input before the first word
TABLE, FAN = 1 << 18, 16
#: A window with fewer tokens than this takes a step that is shorter by as much.
FULL_STEP = 2048
#: Bits of a hash by which words of the table are looked up.
BITS = 20
#: Texts that are held at once in training, and their tokens.
HELD_TEXTS, HELD_TOKENS = 16384, 1 << 22
#: Tokens whose texts are held at once in scoring: with many, lanes are seldom empty.
SCORED_TOKENS = 1 << 22
#: Lanes in scoring, where no step waits for the one before: more than in learning, for less work a token.
SCORED_LANES = 1024
#: Tokens of a part are at least the square root of this times all tokens.
PART_TOKENS = 400_000
LANES, WINDOW, RATE, SMOOTH = 256, 16, 0.3, 0.1
#: Texts of so many tokens are learned in twice the lanes, for less work a token, at a rate that is larger by the root of two.
WIDE_TOKENS = 1 << 20
#: Steps of a window at most: where few lanes are left it is longer, so that it holds about as many tokens.
LONG_WINDOW = 256
#: Sums whose absolute values stay below this need no greatest one taken off before they become exponents in 32 bits.
SAFE = 60.0
#: Stands for the end token among word hashes.
END = 0
LN10 = np.log(10.0)


def places_for(distinct: int) -> int:
    """Words with places of their own, the end included: a power of two near the square root of the vocabulary."""
    return max(PLACES, 1 << distinct.bit_length() // 2)


def parts_for(tokens: int) -> tuple[int, int]:
    """Parts and rounds of training."""
    parts = max(1, round((tokens / PART_TOKENS) ** 0.5))
    return parts, 2 + parts.bit_length() // 2


def read(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, rare class and text of each word, lower-cased."""
    buf, offsets = tb.pack(texts)
    buf = tb.LOWER[buf]
    starts, ends = tb.spans(buf, tb.SPACE)
    last = buf[ends - 1].astype(np.int64)
    before = np.where(ends - starts > 1, buf[np.maximum(ends - 2, 0)], 0)
    return tb.span_hashes(buf, starts, ends).view(np.int64), (last * 31 + before) % RARE, np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, offsets)))


def _counted(batches):
    """Word counts of a partition's training texts; what has grown large is given on in parts."""

    def merged(parts):
        h, c, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(h, kind="stable")
        h, c, n = h[order], c[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, int)
        return h[first], c[first], np.add.reduceat(n, first) if len(h) else n

    held, size, texts = [], 0, 0
    for b in batches:
        values = b["text"].tolist()
        texts += len(values)
        for lo, hi in tb.chunks(values, 1 << 20, 4096):
            h, c, _ = read(values[lo:hi])
            held.append(merged([(h, c, np.ones(len(h), np.int64))]))
            size += len(held[-1][0])
            if size > 3_000_000:
                held = [merged(held)]
                size = len(held[0][0])
                if size > 1_500_000:
                    yield pd.DataFrame(dict(zip(("hash", "cls", "n"), held.pop(), strict=True)))
                    size = 0
    held.append((np.array([END]), np.array([-1]), np.array([texts])))
    yield pd.DataFrame(dict(zip(("hash", "cls", "n"), merged(held), strict=True)))


class Vocabulary:
    """The counts that every task gets: words of the table, which of them have places, and class sums."""

    def __init__(self, words: pd.DataFrame, end_count: int, rare_sums: dict[int, float], places: int = PLACES):
        self.places, self.classes = places, 1 << (places.bit_length() - 1) // 2
        self.width, self.kind = places // self.classes, np.uint16 if places + RARE < 1 << 16 else np.uint32
        words = words.sort_values(["n", "hash"], ascending=[False, True]).reset_index(drop=True)
        place = np.full(len(words), -1, np.int64)
        place[: places - 1] = np.arange(1, min(len(words), places - 1) + 1)
        count = np.zeros(places)
        count[0] = end_count
        top = words["n"].to_numpy()[: places - 1]
        count[1 : len(top) + 1] = top
        order = np.argsort(words["hash"].to_numpy(np.int64), kind="stable")
        self.hash, self.count, self.place = words["hash"].to_numpy(np.int64)[order], words["n"].to_numpy(np.float64)[order], place[order]
        # words of the table by the first bits of their hashes: where each group begins, and the most in one
        self.begins = np.searchsorted(self.hash >> 64 - BITS, np.arange(-1 << BITS - 1, (1 << BITS - 1) + 1)).astype(np.int32)
        self.most = int(np.diff(self.begins).max())
        self.log = np.log10(self.count + SMOOTH)
        self.used = np.zeros(places, bool)
        self.used[: len(top) + 1] = True
        self.end_count, self.place_count = end_count, count
        inside = np.bincount(words["cls"].to_numpy(np.int64)[: len(top)], top + SMOOTH, RARE) if len(top) else np.zeros(RARE)
        self.rare_mass = np.maximum([rare_sums.get(r, 0.0) - inside[r] for r in range(RARE)], 0) + SMOOTH

    def find(self, h: np.ndarray) -> np.ndarray:
        """Where words stand in the table; of those that do not, any place."""
        group = (h >> 64 - BITS) + (1 << BITS - 1)
        at = np.minimum(self.begins[group], len(self.hash) - 1)
        left = np.flatnonzero(self.hash[at] != h)
        for step in range(1, self.most):
            left = left[self.begins[group[left]] + step < self.begins[group[left] + 1]]
            at[left] = self.begins[group[left]] + step
            left = left[self.hash[at[left]] != h[left]]
        return at

    def encode(self, texts: list[str]) -> dict[str, list]:
        """Ids, the sums of log counts of words in the table, and the hashes of words that are not."""
        h, cls, doc = read(texts)
        n, ids = len(texts), self.places + cls
        log_placed, log_table, known = np.full(n, np.log10(self.end_count + SMOOTH)), np.zeros(n), np.full(n, int(self.end_count > 0))
        missing = np.ones(len(h), bool)
        if len(self.hash):
            at = self.find(h)
            missing = self.hash[at] != h
            value, place = self.log[at], self.place[at]
            placed = ~missing & (place >= 0)
            ids[placed] = place[placed]
            other = ~missing & ~placed
            log_placed += np.bincount(doc[placed], value[placed], n)
            log_table += np.bincount(doc[other], value[other], n)
            known += np.bincount(doc[~missing], minlength=n)
        edges = np.searchsorted(doc, np.arange(n + 1))
        ids, far = ids.astype(self.kind), h[missing]
        far_edges = np.searchsorted(doc[missing], np.arange(n + 1))
        return {
            "ids": [np.append(ids[edges[i] : edges[i + 1]], self.kind(0)).tobytes() for i in range(n)], "n_tokens": (np.diff(edges) + 1).tolist(), "known": known.tolist(),
            "log_placed": log_placed.tolist(), "log_table": log_table.tolist(), "far": [far[far_edges[i] : far_edges[i + 1]] for i in range(n)],
        }


class Model:
    """The network: embedding, gated recurrent unit, class softmax and softmax in each class."""

    def __init__(self, vocab: Vocabulary, seed: int = 7):
        rng = np.random.default_rng(seed)
        of = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0] if len(shape) > 1 else 1)).astype(np.float32)
        log = lambda x: np.log(np.maximum(x, 1e-30)).astype(np.float32)
        CLASSES, WIDTH = self.classes, self.width = vocab.classes, vocab.width
        self.places, self.start, self.kind = vocab.places, vocab.places + RARE, vocab.kind
        count = np.where(vocab.used, vocab.place_count + SMOOTH, 0).reshape(CLASSES, WIDTH)
        mass = np.concatenate([count.sum(1), vocab.rare_mass])
        self.p = {
            "E": rng.standard_normal((self.start + 1, HIDDEN)).astype(np.float32) * np.float32(0.3), "W": of(HIDDEN, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, np.float32), "U": of(HIDDEN, 3 * HIDDEN),
            "C": np.zeros((HIDDEN, CLASSES + RARE), np.float32), "c": log(mass / max(mass.sum(), 1e-30)),
            "I": np.zeros((CLASSES, HIDDEN, WIDTH), np.float32), "i": log(count / np.maximum(mass[:CLASSES, None], 1e-30)),
        }
        self.rare_log = np.log(vocab.rare_mass)
        self.seen = {k: np.full(v.shape, 1e-3, np.float32) for k, v in self.p.items()}

    def vector(self) -> np.ndarray:
        """Weights and their sums of squared gradients."""
        return np.concatenate([of[k].ravel() for of in (self.p, self.seen) for k in sorted(of)])

    def set_vector(self, v: np.ndarray) -> None:
        at = 0
        for of in (self.p, self.seen):
            for k in sorted(of):
                n = of[k].size
                of[k] = v[at : at + n].reshape(of[k].shape).astype(np.float32)
                at += n

    def _heads(self, hs: np.ndarray, y: np.ndarray, learn: bool):
        """Log-probabilities of the targets, and the gradients if asked for.

        Targets are held by class and one to a column, so each class is a slice and sums over classes and words go along rows.
        """
        p, n, CLASSES, WIDTH, PLACES = self.p, len(y), self.classes, self.width, self.places
        cls = np.where(y < PLACES, y // WIDTH, CLASSES + y - PLACES).astype(np.uint16)
        order = np.argsort(cls, kind="stable")
        cls, y, given = cls[order].astype(np.int64), y[order], np.ones((HIDDEN + 1, n), np.float32)  # a last row of ones takes the bias
        given[:HIDDEN] = hs[order].T
        edges, numbers = np.searchsorted(cls, np.arange(CLASSES + 1)).tolist(), np.arange(n)

        def joined(weight, bias):
            """Weights with their bias, and whether all sums stay where no exponent is too large or small; a state's values are within 1."""
            reach = np.abs(weight).sum(-2)
            return np.concatenate([weight, bias[..., None, :]], axis=-2), ((bias + reach).max(-1) < SAFE) & ((bias - reach).max(-1) > -SAFE)

        def softmax(weight, safe, h, target):
            prob = weight.T @ h
            at = target * h.shape[1] + numbers[: h.shape[1]]
            if not safe:
                prob -= prob.max(0)
            value = prob.take(at)
            np.exp(prob, out=prob)
            total = prob.sum(0)
            value -= np.log(total)
            if learn:
                prob /= total
                prob.reshape(-1)[at] -= 1
            return value, prob

        value, prob = softmax(*joined(p["C"], p["c"]), given, cls)
        out = value.astype(np.float64)
        out[edges[CLASSES] :] -= self.rare_log[cls[edges[CLASSES] :] - CLASSES]
        grad = {}
        if learn:
            both, dh = given @ prob.T, p["C"] @ prob
            grad["C"], grad["c"] = both[:HIDDEN], both[HIDDEN]
            inner = np.zeros((CLASSES, HIDDEN + 1, WIDTH), np.float32)
        weights, safe = joined(p["I"], p["i"])
        safe, word = safe.tolist(), y % WIDTH
        for k in range(CLASSES):
            at = slice(edges[k], edges[k + 1])
            if at.start == at.stop:
                continue
            h = given[:, at]
            value, prob = softmax(weights[k], safe[k], h, word[at])
            out[at] += value
            if learn:
                np.matmul(h, prob.T, out=inner[k])
                dh[:, at] += p["I"][k] @ prob
        if learn:
            grad["I"], grad["i"] = inner[:, :HIDDEN], inner[:, HIDDEN]
        found = np.empty(n)
        found[order] = out
        if not learn:
            return found, None, None
        back = np.empty((n, HIDDEN), np.float32)
        back[order] = dh.T
        return found, grad, back

    def group(self, seqs: list[np.ndarray], learn: bool = False, lane: np.ndarray | None = None) -> np.ndarray:
        """Log-likelihood (natural) of each sequence. learn: weights move after each window.

        lane: the lane that each sequence goes through, one behind the other, each from an empty state; without it each has its own, and the longest come first.
        """
        own = np.array([len(s) for s in seqs])
        order = np.arange(len(seqs))
        length = own
        if lane is not None:
            load = np.bincount(lane, own).astype(np.int64)
            by_load = np.argsort(-load, kind="stable")
            rank = np.empty_like(by_load)
            rank[by_load] = np.arange(len(load))
            order, length = np.argsort(rank[lane], kind="stable"), load[by_load]
        flat, text = np.concatenate([seqs[i] for i in order]), np.repeat(order.astype(np.int32), own[order])
        begins = np.zeros(len(flat), bool)
        begins[np.concatenate([[0], np.cumsum(own[order])[:-1]])] = True
        offset = np.concatenate([[0], np.cumsum(length)[:-1]])
        wide = 2 if len(flat) >= WIDE_TOKENS else 1
        score, state = np.zeros(len(seqs)), np.zeros((HIDDEN, len(length)), np.float32)  # a lane is a column, so each gate is a slice
        H = HIDDEN
        starts, last = int(length[0]) - length, int(length[0])  # all lanes end together, so the last steps are learned from many texts
        active = lambda t: int(np.searchsorted(starts, t))
        t0 = steps = 0
        while (t0 := t0 + steps) < last:
            steps = min(WINDOW, last - t0)
            while 2 * steps <= min(LONG_WINDOW, last - t0) and 2 * steps * active(t0 + 2 * steps) <= (LANES * wide if learn else SCORED_LANES) * WINDOW:
                steps *= 2
            lanes = active(t0 + steps)
            at = t0 + np.arange(steps)[:, None] - starts[None, :lanes]
            valid = at >= 0
            where = offset[None, :lanes] + np.maximum(at, 0)
            y, new_text = flat[where].astype(np.int64), begins[where]
            x = np.where(new_text, self.start, flat[np.maximum(where - 1, 0)])
            again = new_text.any(1).tolist()
            p = self.p
            table, U = np.ascontiguousarray((p["E"] @ p["W"] + p["b"]).T), np.ascontiguousarray(p["U"].T)
            for of in (table, U):  # gates need the negative sum
                np.negative(of[: 2 * H], out=of[: 2 * H])
            h = state[:, :lanes].copy()
            hs, zr = np.empty((steps, H, lanes), np.float32), np.empty((steps, 2 * H, lanes), np.float32)
            if learn:
                before, new_part, from_state = (np.empty((steps, H, lanes), np.float32) for _ in range(3))
            for t in range(steps):
                if again[t]:
                    h = np.where(new_text[t], np.float32(0), h)
                into, g = table.take(x[t], axis=1), U @ h
                gate = np.add(into[: 2 * H], g[: 2 * H], out=zr[t])
                np.exp(gate, out=gate)
                gate += 1
                np.reciprocal(gate, out=gate)
                n = gate[H:] * g[2 * H :]
                n += into[2 * H :]
                np.tanh(n, out=n)
                if learn:
                    before[t], new_part[t], from_state[t] = h, n, g[2 * H :]
                h = np.subtract(h, n, out=hs[t])
                h *= gate[:H]
                h += n
            sel = np.flatnonzero(valid.ravel())
            out, grad, dh = self._heads(hs.transpose(0, 2, 1).reshape(-1, H)[sel], y.ravel()[sel], learn)
            score += np.bincount(text[where].ravel()[sel], out, len(seqs))
            state[:, :lanes] = h
            if not learn:
                continue
            d_out = np.zeros((steps * lanes, H), np.float32)
            d_out[sel] = dh
            d_out = np.ascontiguousarray(d_out.reshape(steps, lanes, H).transpose(0, 2, 1))
            # what a step's gradients are multiplied by, for all steps at once
            z, r = zr[:, :H], zr[:, H:]
            to_n = (1 - z) * (1 - new_part * new_part)
            to_rec = np.concatenate([(before - new_part) * z * (1 - z), to_n * from_state * r * (1 - r), to_n * r], axis=1).reshape(steps, 3, H, lanes)
            d_rec, back = np.empty((steps, 3, H, lanes), np.float32), np.zeros((H, lanes), np.float32)
            for t in range(steps - 1, -1, -1):
                d = d_out[t]
                d += back
                np.multiply(d, to_rec[t], out=d_rec[t])
                back = p["U"] @ d_rec[t].reshape(3 * H, lanes)
                back += d * z[t]
                if again[t]:
                    back[:, new_text[t]] = 0
            grad["U"] = np.matmul(before, d_rec.reshape(steps, 3 * H, lanes).transpose(0, 2, 1)).sum(0)
            d_rec[:, 2] = d_out * to_n
            d_in = d_rec.reshape(steps, 3 * H, lanes).transpose(0, 2, 1)
            d_in = d_in.reshape(-1, 3 * H)
            xs = x.ravel()
            order = np.argsort(xs.astype(self.kind), kind="stable")
            first = np.flatnonzero(np.concatenate([[True], xs[order][1:] != xs[order][:-1]]))
            summed, used = np.add.reduceat(d_in[order], first), xs[order][first]
            grad["b"], grad["W"] = summed.sum(0), p["E"][used].T @ summed
            grad["E"] = np.zeros_like(p["E"])
            grad["E"][used] = summed @ p["W"].T
            scale = np.float32(1 / max(len(sel), LANES))
            rate = np.float32(RATE * wide**0.5 * min(1.0, len(sel) / FULL_STEP / wide))  # a few texts that go on alone move little
            for k, g in grad.items():  # Adagrad on clipped gradients
                g = np.clip(g * scale, -0.1, 0.1)
                self.seen[k] += g * g
                p[k] = p[k] - rate * g / np.sqrt(self.seen[k])
        return score

    def over(self, seqs: list[np.ndarray], learn: bool = False) -> np.ndarray:
        """Log-likelihood of each sequence. The longest are dealt first, each to the lane that is free first; in learning a lane's texts then go in the order given."""
        if not len(seqs):
            return np.zeros(0)
        order = np.argsort([-len(s) for s in seqs], kind="stable")
        lanes = (LANES * (2 if sum(map(len, seqs)) >= WIDE_TOKENS else 1)) if learn else SCORED_LANES
        free, lane = [(0, k) for k in range(lanes)], np.zeros(len(seqs), np.int64)
        for i in order:
            load, lane[i] = free[0]
            heapq.heapreplace(free, (load + len(seqs[i]), int(lane[i])))
        if learn:
            return self.group(seqs, True, lane)
        out = np.zeros(len(seqs))
        out[order] = self.group([seqs[i] for i in order], lane=lane[order])
        return out

    def ids(self, column) -> list[np.ndarray]:
        return [np.frombuffer(b, self.kind) for b in column]


def learned(model: Model, batches):
    """Runs a model over texts (``part, ids``) that come part by part: a row ``part, tokens, v`` for each, the weights times tokens.

    Each part starts from the model as it is given. Texts are learned in blocks whose ends depend on them alone.
    """
    start, part, held, size, tokens = model.vector(), None, [], 0, 0

    def block():
        nonlocal held, size
        model.over(held, learn=True)
        held, size = [], 0

    def done():
        block()
        return pd.DataFrame({"part": [part], "tokens": [tokens], "v": [(model.vector().astype(np.float64) * tokens).tobytes()]})

    for b in batches:
        for p, seq in zip(b["part"].tolist(), model.ids(b["ids"]), strict=True):
            if p != part:
                if part is not None:
                    yield done()
                    model.set_vector(start)
                part, tokens = p, 0
            held.append(seq)
            size, tokens = size + len(seq), tokens + len(seq)
            if len(held) == HELD_TEXTS or size >= HELD_TOKENS:
                block()
    if part is not None:
        yield done()


def _homes(spark, parts: int) -> list[int]:
    """A number for each part that hash partitioning puts into the partition of the same number."""
    found: dict[int, int] = {}
    n = 32 * parts
    while len(found) < parts:
        found = {r["p"]: r["v"] for r in spark.range(n).select(F.pmod(F.hash("id"), F.lit(parts)).alias("p"), F.col("id").alias("v")).groupBy("p").agg(F.min("v").alias("v")).collect()}
        n *= 2
    return [found[p] for p in range(parts)]


def trained(model: Model, texts: DataFrame, parts: int, rounds: int) -> Model:
    """The model after all rounds over ``texts`` (``hash, part, round, ids``). A round's texts are dealt by part, one to a partition."""
    sc, shape = texts.sparkSession.sparkContext, "part long, tokens long, v binary"
    homes = F.array(*(F.lit(h).cast("long") for h in _homes(texts.sparkSession, parts)))
    texts = texts.withColumn("home", F.get(homes, F.col("part").cast("int")))

    def added(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        v = np.sum([np.frombuffer(x) for x in group["v"]], axis=0)
        return pd.DataFrame({"part": [int(group["part"].iloc[0]) // FAN], "tokens": [int(group["tokens"].sum())], "v": [v.tobytes()]})

    for r in range(rounds):
        sent = sc.broadcast(model)
        dealt = texts.filter(F.col("round") == r).repartition(parts, "home").sortWithinPartitions("part", "hash", "ids")
        own = settled(dealt.select("part", "ids").mapInPandas(lambda batches, sent=sent: learned(copy.deepcopy(sent.value), batches), shape))
        while own.count() > FAN:
            own = settled(own.groupBy((F.col("part") / FAN).cast("long").alias("up")).applyInPandas(lambda g: added(g), shape))
        if got := sorted(own.collect(), key=lambda x: x["part"]):
            model.set_vector(np.sum([np.frombuffer(x["v"]) for x in got], axis=0) / sum(x["tokens"] for x in got))
    return model


def top_words(words: DataFrame) -> DataFrame:
    """The most frequent of ``words`` (``hash, n``), at most ``TABLE``. Of equal counts those of the least hashes are taken, to within a range of hashes."""
    kept, last = 0, None
    for r in words.groupBy("n").agg(F.count("*").alias("v")).orderBy(F.desc("n")).toLocalIterator():
        last = r["n"]
        if kept + r["v"] > TABLE:
            break
        kept += r["v"]
    else:
        return words
    bucket, end = F.shiftright("hash", 48), None
    for r in words.filter(F.col("n") == last).groupBy(bucket.alias("b")).agg(F.count("*").alias("v")).orderBy("b").toLocalIterator():
        end = r["b"]
        kept += r["v"]
        if kept > TABLE:
            break
    return words.filter((F.col("n") > last) | ((F.col("n") == last) & (bucket < end)))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``."""
    sc = docs.sparkSession.sparkContext
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), (F.crc32(id_text(F.col(id_col)).cast("binary")) % 10 == 0).alias("held_out"))
    found = docs.filter("not held_out").select("text").mapInPandas(_counted, "hash long, cls long, n long")
    counts = settled(found.groupBy("hash").agg(F.min("cls").alias("cls"), F.sum("n").alias("n")).filter("n > 0"))
    sums = {r["cls"]: (r["n"], r["v"]) for r in counts.groupBy("cls").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    total, distinct = sum(n for n, _ in sums.values()), sum(v for _, v in sums.values())
    top = top_words(counts.filter("cls >= 0")).toPandas()
    vocab = Vocabulary(top, sums.get(-1, (0, 0))[0], {c: n + SMOOTH * v for c, (n, v) in sums.items() if c >= 0}, places_for(distinct))
    sent = sc.broadcast(vocab)
    columns = "doc_id {id}, held_out boolean, row long, hash long, ids binary, n_tokens long, known long, log_placed double, log_table double, far array<long>".replace("{id}", docs.schema["doc_id"].dataType.simpleString())

    def encoded(batches):
        for b in batches:
            values = b["text"].tolist()
            parts = [sent.value.encode(values[lo:hi]) for lo, hi in tb.chunks(values, 1 << 20, 4096)]
            for k in parts[0] if parts else ():
                b[k] = [x for part in parts for x in part[k]]
            if parts:
                yield b.drop(columns="text")

    rows = settled(docs.withColumns({"row": F.monotonically_increasing_id(), "hash": F.xxhash64(id_text(F.col("doc_id")), "text")}).select("doc_id", "held_out", "row", "hash", "text").mapInPandas(encoded, columns))

    parts, rounds = parts_for(total)
    turn = F.expr(f"pmod(hash div {parts}, {rounds})")
    dealt = rows.filter("not held_out").select("hash", "ids", F.pmod("hash", F.lit(parts)).alias("part"), turn.alias("round"))
    model = trained(Model(vocab), dealt, parts, rounds)
    net = sc.broadcast(model)

    def judged(batches):
        held, size = [], 0

        def block():
            nonlocal held, size
            own = pd.concat(held, ignore_index=True)
            own["net"] = net.value.over(net.value.ids(own["ids"])) / LN10
            held, size = [], 0
            return own.drop(columns=["ids", "hash"])

        for b in batches:
            held.append(b)
            size += int(b["n_tokens"].sum())
            if size >= SCORED_TOKENS:
                yield block()
        if held:
            yield block()

    kept_columns = columns.replace(", hash long, ids binary", "").replace(", far array<long>", "")
    scored = rows.drop("far").mapInPandas(judged, kept_columns + ", net double")
    far = rows.select("row", F.explode("far").alias("hash")).groupBy("row", "hash").agg(F.count("*").alias("k"))
    n = F.coalesce("n", F.lit(0))
    far = far.join(counts.filter("cls >= 0").select("hash", "n"), "hash", "left").groupBy("row").agg(F.sum(F.col("k") * F.log10(n + F.lit(SMOOTH))).alias("log_far"), F.sum(F.when(n > 0, F.col("k")).otherwise(0)).alias("far_known"))
    base = np.log10(total + SMOOTH * (distinct + 1))
    log_far = F.coalesce("log_far", F.lit(0.0))
    return scored.join(far, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("far_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("log_placed") + F.col("log_table") + log_far - F.col("n_tokens") * F.lit(float(base))).alias("base_score"),
        (F.col("net") + F.col("log_table") + log_far).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


