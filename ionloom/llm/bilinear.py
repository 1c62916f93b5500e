"""A log-bilinear neural model over thousands of symbols, trained in numpy by noise-contrastive estimation.

The vectors of the two symbols before a token, each through its place's matrix, add up to a query. Symbols lie in groups of
equal size by frequency, about as many groups as each has members: the query meets the groups' vectors, then those of the
members of one group. Both steps are normalised by batched matrix products, so a token costs the square root of the number of
symbols, and its probabilities add up to one.
"""

from __future__ import annotations

import numpy as np

WIDTH = 32
#: Tokens of a training step; false groups drawn for the step, and false members drawn for each of its tokens' groups.
BATCH, FALSE_GROUPS, FALSE_MEMBERS = 1024, 24, 16
#: Groups of at most so many tokens in a step are multiplied together.
FEW = 8
RATE = 0.12
#: Tokens whose probabilities are computed at a time.
SCORED = 1 << 13


class LogBilinear:
    """Parameters and what they are about. Before training it is the unigram model of the symbols' counts (plus one)."""

    def __init__(self, counts: np.ndarray, seed: int = 0, width: int = WIDTH):
        n = len(counts)
        self.size = size = int(np.ceil(np.sqrt(n)))
        order = np.argsort(-counts, kind="stable")
        self.position = np.empty(n, np.int64)
        self.position[order] = np.arange(n)
        self.reach = np.concatenate([[0.0], np.cumsum(counts[order] + 1.0)])
        self.low = np.arange(0, n, size)
        self.high = np.minimum(n, self.low + size)
        whole = self.reach[self.high] - self.reach[self.low]
        self.group_share = whole / whole.sum()
        rng = np.random.default_rng(seed)
        self.parameters = [
            rng.normal(0, 0.1, (n, width)).astype(np.float32), np.eye(width, dtype=np.float32), 0.5 * np.eye(width, dtype=np.float32), np.zeros((len(self.low), width), np.float32),
            np.log(self.group_share).astype(np.float32), np.zeros((n, width), np.float32), np.log((counts[order] + 1.0) / np.repeat(whole, self.high - self.low)).astype(np.float32),
        ]

    @property
    def vector(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters])

    def load(self, vector: np.ndarray) -> LogBilinear:
        at = 0
        for k, p in enumerate(self.parameters):
            self.parameters[k] = vector[at : at + p.size].reshape(p.shape).astype(np.float32)
            at += p.size
        return self

    def ready(self) -> None:
        """Every symbol's share of a query, by place, with a last column that biases meet."""
        context, near, far, upper, upper_bias, target, bias = self.parameters
        one = np.ones((len(context), 1), np.float32)
        self.from_far, self.from_near = np.hstack([context @ far, one]), np.hstack([context @ near, 0 * one])
        self.groups = np.ascontiguousarray(np.hstack([upper, upper_bias[:, None]]).T)
        whole = np.hstack([target, bias[:, None]])
        self.members = [np.ascontiguousarray(whole[lo:hi].T) for lo, hi in zip(self.low, self.high, strict=True)]
        reach = lambda x: float(np.sqrt((x[:, :-1] ** 2).sum(1).max()))
        widest = max(reach(self.groups.T), reach(whole)) * (reach(self.from_far) + reach(self.from_near))
        self.safe = widest + max(float(np.abs(upper_bias).max()), float(np.abs(bias).max())) > 80  # exponentials could overflow

    def log_probabilities(self, two: np.ndarray, one: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Natural logarithms for symbols after two and one."""
        out = np.empty(len(symbol))
        for at in range(0, len(symbol), SCORED):
            q = self.from_far[two[at : at + SCORED]]
            q += self.from_near[one[at : at + SCORED]]
            place = self.position[symbol[at : at + SCORED]]
            group = place // self.size
            log_p = self._normalised(q @ self.groups, group)
            order = np.argsort(group.astype(np.int16 if len(self.low) < 1 << 15 else np.int64), kind="stable")
            edge = np.concatenate([[0], np.flatnonzero(np.diff(group[order])) + 1, [len(order)]])
            q, inside = q[order], (place - group * self.size)[order]
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if a < b:
                    log_p[order[a:b]] += self._normalised(q[a:b] @ self.members[group[order[a]]], inside[a:b])
            out[at : at + SCORED] = log_p
        return out

    def _normalised(self, scores: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Log-softmax of each row at its chosen column; scores are used up."""
        if self.safe:
            scores -= scores.max(1, keepdims=True)
        picked = scores[np.arange(len(chosen)), chosen]
        np.exp(scores, out=scores)
        return picked - np.log(scores @ np.ones(scores.shape[1], np.float32))


class _Rows:
    """Adagrad on rows of a table, each with one step size of its own."""

    def __init__(self, table: np.ndarray):
        self.table, self.seen = table, np.full(len(table), 1e-6, np.float32)

    def move(self, rows: np.ndarray, total: np.ndarray, rate: float) -> None:
        """Down the gradients of different rows."""
        self.seen[rows] += np.einsum("nw,nw->n", total, total) / total.shape[1] if total.ndim > 1 else total * total
        step = rate / np.sqrt(self.seen[rows])
        self.table[rows] -= total * (step[:, None] if total.ndim > 1 else step)


def run_starts(sorted_places: np.ndarray) -> np.ndarray:
    """Where runs of equal places begin."""
    fresh = np.ones(len(sorted_places), bool)
    np.not_equal(sorted_places[1:], sorted_places[:-1], out=fresh[1:])
    return np.flatnonzero(fresh)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Trainer:
    """Noise-contrastive estimation: each token's group against groups drawn by their frequency, and the token against members of its group drawn by theirs.

    Tokens of a step share what is drawn, those of one group its members.
    """

    def __init__(self, model: LogBilinear, seed: int = 0, rate: float = RATE):
        self.model, self.rng, self.rate, self.seen = model, np.random.default_rng(seed), rate, 0
        context, near, far, upper, upper_bias, target, bias = model.parameters
        self.context, self.upper, self.upper_bias, self.target, self.bias = map(_Rows, (context, upper, upper_bias, target, bias))
        self.squares = [np.full(m.shape, 1e-6, np.float32) for m in (near, far)]
        self.log_groups = np.log(FALSE_GROUPS * model.group_share).astype(np.float32)
        self.reached_groups = np.cumsum(model.group_share)
        share = np.diff(model.reach) / np.repeat(model.reach[model.high] - model.reach[model.low], model.high - model.low)
        self.log_members = np.log(FALSE_MEMBERS * share).astype(np.float32)
        self.kind = np.min_scalar_type(len(model.position))  # of 16 bits, they are sorted by their digits

    def step(self, two: np.ndarray, one: np.ndarray, symbol: np.ndarray) -> None:
        model, rng = self.model, self.rng
        context, near, far, upper, upper_bias, target, bias = model.parameters
        n = len(symbol)
        self.seen += n
        place = model.position[symbol]
        order = np.argsort(place.astype(self.kind), kind="stable")
        place, two, one = place[order], two[order], one[order]
        group = place // model.size
        edge = run_starts(group)
        own = group[edge]
        size = np.diff(np.append(edge, n))
        # each context symbol meets its matrix once
        q, contexts = 0, []
        for at, matrix in ((one, near), (two, far)):
            by = np.argsort(at.astype(self.kind), kind="stable")
            first = run_starts(at[by])
            rows = at[by[first]]
            of = np.empty(n, np.int64)
            of[by] = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
            vectors = context[rows]
            q = q + (vectors @ matrix).take(of, 0)
            contexts.append((by, first, rows, vectors, matrix))
        false = np.minimum(np.searchsorted(self.reached_groups, rng.random(FALSE_GROUPS)), len(model.low) - 1)
        theirs = np.repeat(upper[own], size, axis=0)
        hit = _sigmoid(np.einsum("nw,nw->n", q, theirs) + np.repeat(upper_bias[own] - self.log_groups[own], size)) - 1
        miss = _sigmoid(q @ upper[false].T + (upper_bias[false] - self.log_groups[false]))
        bottom, top = model.reach[model.low[own]], model.reach[model.high[own]]
        drawn = np.searchsorted(model.reach, bottom[:, None] + np.sort(rng.random((len(own), FALSE_MEMBERS)), axis=1) * (top - bottom)[:, None], "right") - 1
        drawn = np.clip(drawn, model.low[own][:, None], model.high[own][:, None] - 1)
        wrong, right = target[drawn], target[place]
        many, few = np.flatnonzero(size > FEW).tolist(), np.flatnonzero(size <= FEW)
        spans = [(k, int(edge[k]), int(edge[k] + size[k])) for k in many]
        there = np.arange(FEW) < size[few][:, None]
        padded = np.where(there, edge[few][:, None] + np.arange(FEW), 0)
        inside, q_few, wrong_few = padded[there], q[padded], wrong[few]
        miss_in = np.repeat(bias[drawn] - self.log_members[drawn], size, axis=0)
        miss_in[inside] += (q_few @ wrong_few.transpose(0, 2, 1))[there]
        for k, lo, hi in spans:
            miss_in[lo:hi] += q[lo:hi] @ wrong[k].T
        hit_in = _sigmoid(np.einsum("nw,nw->n", q, right) + (bias[place] - self.log_members[place])) - 1
        miss_in = _sigmoid(miss_in)
        g = miss @ upper[false]
        g += hit[:, None] * theirs
        g += hit_in[:, None] * right
        # what a group's tokens add to its members, in turn, and to itself
        each, pushed = np.hstack([miss_in, hit[:, None]]), np.empty((len(own), FALSE_MEMBERS + 1, q.shape[1]), np.float32)
        each_few = each[padded] * there[:, :, None]
        g[inside] += (each_few[:, :, :-1] @ wrong_few)[there]
        pushed[few] = each_few.transpose(0, 2, 1) @ q_few
        for k, lo, hi in spans:
            g[lo:hi] += miss_in[lo:hi] @ wrong[k]
            np.matmul(each[lo:hi].T, q[lo:hi], out=pushed[k])
        alone = np.add.reduceat(each, edge, axis=0)
        # all gradients are of the parameters as they were
        moves = []
        for square, (by, first, rows, vectors, matrix) in zip(self.squares, contexts, strict=True):
            total = np.add.reduceat(g[by], first, axis=0)
            moves.append((self.context, rows, total @ matrix.T))
            gradient = vectors.T @ total
            square += gradient * gradient
            matrix -= self.rate * 0.1 * gradient / np.sqrt(square)
        pulled, mine = np.zeros_like(upper), np.zeros_like(upper_bias)
        pulled[own], mine[own] = pushed[:, -1], alone[:, -1]
        np.add.at(pulled, false, miss.T @ q)
        np.add.at(mine, false, miss.sum(0))
        some = np.union1d(own, false)
        moves += [(self.upper, some, pulled[some]), (self.upper_bias, some, mine[some])]
        for at, vectors, numbers in ((place, hit_in[:, None] * q, hit_in), (drawn.ravel(), pushed[:, :-1].reshape(-1, q.shape[1]), alone[:, :-1].ravel())):
            first = run_starts(at)
            moves += [(self.target, at[first], np.add.reduceat(vectors, first, axis=0)), (self.bias, at[first], np.add.reduceat(numbers, first))]
        for table, rows, total in moves:
            table.move(rows, total, self.rate)
