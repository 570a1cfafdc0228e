"""A gated recurrent language model in numpy, trained and applied by Spark tasks.

Words are predicted in two steps: a softmax over classes, then one over the words of the class.
Frequent words stand in classes of CLASS_WORDS, whose inner softmax depends on the state, too;
all others fall into classes by their ending, where a word has its smoothed share of the counts
of the whole training corpus. Training is truncated backpropagation: windows of WINDOW tokens,
the state carried from one to the next. Each round, every task trains on its documents from the
same parameters, and the results are averaged by tokens. A document is scored from its first to
its last token with one state carried across all windows.
"""

from __future__ import annotations

import heapq
import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.llm.common import pinned, summed_vectors
from rastro.llm.folds import held_out

PARTS, PART = 7, 2

#: Words with a place in the network, words of a class, and classes by ending.
VOCABULARY, CLASS_WORDS, ENDINGS = 4095, 64, 64
#: Words whose counts every task holds, and bytes of the longest; the rest is joined.
COUNTED, COUNTED_BYTES = 400_000, 64
WIDTH, STATE = 16, 16
LANES, WINDOW, RATE = 128, 16, 0.004
#: Scoring gives the same for any number of lanes.
SCORE_LANES = 512
#: Every training document is in one round.
ROUNDS = 4
#: Tokens that a task trains on at a time.
TRAIN_TOKENS = 524_288
#: Bytes of texts that a task numbers at a time, and counts before it passes them on.
TEXT_BYTES, COUNT_BYTES = 16 << 20, 32 << 20
#: Bytes of numbered documents that a task scores at a time, two for a token.
SCORE_BYTES = 6 << 20
CHUNK = 8192
#: Parameters that the optimiser takes at a time.
PIECE = 32_768
#: Sums of exponentials within these bounds lose nothing in single precision.
LEAST_SUM, MOST_SUM = 1e-25, 1e25

KEYS = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double"
#: ``model`` has the shares within classes by ending alone.
NUMBERED = KEYS + ", rest array<struct<word: binary, ending: int, n: int>>, numbers binary"


def words_of(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space, in lower case (A-Z), of all texts as bytes, and where
    those of each text begin and end."""
    words, sizes = [], [np.zeros(1, np.int64)]
    for chunk in texts.chunks:
        lists = pc.ascii_split_whitespace(pc.ascii_lower(chunk.fill_null("")))
        own = lists.flatten().cast(pa.large_binary())
        places = lists.offsets.to_numpy().astype(np.int64)
        # White space at either end of a text leaves an empty word there.
        there = pc.binary_length(own).to_numpy() > 0
        words.append(own if there.all() else own.filter(pa.array(there)))
        sizes.append(np.diff(np.concatenate(([0], np.cumsum(there)))[places - places[0]]))
    return pa.concat_arrays([pa.array([], pa.large_binary()), *words]), np.cumsum(np.concatenate(sizes))


def grouped(batches, most=TEXT_BYTES):
    """The batches as tables of about so many bytes."""
    held, size = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts; each task adds up before anything is shuffled."""

    def count(batches):
        for table in grouped(batches, COUNT_BYTES):
            words, _ = words_of(table.column(0))
            found = pc.value_counts(words)
            yield pa.RecordBatch.from_arrays(
                [found.field("values").cast(pa.binary()), found.field("counts")], names=["word", "n"]
            )

    rows = texts.select("text").mapInArrow(count, "word binary, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """What the corpus says about words; of bounded size, so every task holds it."""

    words: list[bytes]  # by count, the commonest first; those of the network lead
    counts: np.ndarray
    total: int  # N: training tokens, an end for each document among them
    distinct: int  # V
    ends: int  # documents
    class_total: np.ndarray  # of each ending: tokens and distinct words outside of the network
    class_distinct: np.ndarray

    def __post_init__(self) -> None:
        self.network = min(VOCABULARY, len(self.words))
        # The end of a text is a word of the network, too.
        self.end = self.network
        self.size = self.network + 1
        self.classes = -(-self.size // CLASS_WORDS)

    def prepare(self) -> None:
        """Logarithms of each counted word's share, and its input number."""
        if hasattr(self, "log_base"):
            return
        self.keys = pa.array(self.words, pa.large_binary())
        floor = self.total + self.distinct + 1
        self.log_base = np.log10((self.counts + 1) / floor)
        self.log_base_end = math.log10((self.ends + 1) / floor)
        tails = np.array([ending(w) for w in self.words[self.network :]], np.int64)
        self.log_in_class = np.log10(
            (self.counts[self.network :] + 1) / (self.class_total + self.class_distinct + 1)[tails]
        )
        self.inputs = np.concatenate([np.arange(self.network), self.size + tails]).astype(np.int32)

    def numbers(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of words among the counted ones, -1 for others, and their input numbers: those
        of the network, else that of their ending."""
        found = pc.index_in(words, value_set=self.keys).fill_null(-1).to_numpy()
        out = np.append(self.inputs, np.int32(0))[found]
        others = np.flatnonzero(found < 0)
        distinct = words.take(pa.array(others)).dictionary_encode()
        endings = np.array([ending(w) for w in distinct.dictionary.to_pylist()], np.int32)
        out[others] = self.size + endings[distinct.indices.to_numpy()]
        return found, out.astype(np.uint16)


def lexicon(counts: DataFrame, documents: int) -> Lexicon:
    """The lexicon of a written table of counts."""
    words, tokens = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # The least count such that not too many words have it: counts in steps of a quarter octave.
    step = F.floor(4 * F.log2(F.col("n").cast("double")))
    by_step = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("c")).collect()
    held, least = 0, 1 << 62
    for row in sorted(by_step, key=lambda r: -r["step"]):
        held += row["c"]
        if held > COUNTED:
            break
        least = math.ceil(2 ** (row["step"] / 4) - 1e-9)
    frequent = counts.filter((F.col("n") >= least) & (F.octet_length("word") <= COUNTED_BYTES)).toArrow()
    table = sorted(
        zip(frequent.column("n").to_pylist(), frequent.column("word").to_pylist()), key=lambda x: (-x[0], x[1])
    )
    network = {w for _, w in table[:VOCABULARY]}
    classes = F.crc32(F.substring("word", -3, 3)) % ENDINGS
    totals = {
        r["e"]: (r["t"], r["d"])
        for r in counts.groupBy(classes.alias("e")).agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("d")).collect()
    }
    total, distinct = (np.array([totals.get(e, (0, 0))[i] for e in range(ENDINGS)], float) for i in (0, 1))
    for n, w in table[:VOCABULARY]:
        total[ending(w)] -= n
        distinct[ending(w)] -= 1
    assert len(network) == min(VOCABULARY, len(table))
    return Lexicon(
        [w for _, w in table],
        np.array([n for n, _ in table], float),
        tokens + documents,
        words + (documents > 0),
        documents,
        total,
        distinct,
    )


def _exponentials(product, chosen: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-softmax of the chosen places of a product's logits, exponentials and their sums along
    an axis. Where a sum is too small or too large, the greatest logits are taken off first."""
    out = product()
    found = out.ravel()[chosen]
    with np.errstate(over="ignore"):
        np.exp(out, out=out)
        sums = out.sum(axis) if axis == 0 else out @ np.ones(out.shape[1], out.dtype)
    if not ((sums > LEAST_SUM) & (sums < MOST_SUM)).all():
        out = product()
        out -= out.max(axis, keepdims=True)
        found = out.ravel()[chosen]
        np.exp(out, out=out)
        sums = out.sum(axis)
    return found - np.log(sums), out, sums


class Network:
    """Parameters, forward and backward passes."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.size, self.classes = lexicon.size, lexicon.classes
        self.outputs = self.classes + ENDINGS
        random = np.random.default_rng(1)

        def small(*shape, scale):
            return (random.standard_normal(shape) * scale).astype(np.float32)

        within = np.full((self.classes, CLASS_WORDS), -1e4, np.float32)
        shares = np.append(lexicon.counts[: lexicon.network], lexicon.ends) + 1
        within.ravel()[: self.size] = np.log(shares)
        mass = np.exp(within.astype(float)).sum(1)
        tails = lexicon.class_total + lexicon.class_distinct + 1
        # Before training the model is that of the counts.
        self.p = {
            "embed": small(self.size + ENDINGS, WIDTH, scale=0.3),
            "input": small(WIDTH, 3 * STATE, scale=WIDTH**-0.5),
            "gate": np.zeros(3 * STATE, np.float32),
            "state": small(STATE, 3 * STATE, scale=STATE**-0.5),
            # Constants stand behind the weights.
            "out": np.zeros((STATE + 1, self.outputs), np.float32),
            "word": np.zeros((self.classes, STATE + 1, CLASS_WORDS), np.float32),
        }
        self.p["out"][-1] = np.log(np.concatenate([mass, tails]))
        self.p["word"][:, -1] = within

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()]).astype(float)

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for name, value in self.p.items():
            self.p[name] = flat[at : at + value.size].reshape(value.shape).astype(np.float32)
            at += value.size
        return self

    def states(self, inputs, fresh, state):
        """The state behind a window (lanes, STATE), and by step and lane, lanes last: states
        before each step, gates, the state's part of the candidates, candidates, states after.
        ``fresh`` lanes begin anew."""
        p, n, shape = self.p, STATE, inputs.shape
        embedded = np.take(p["embed"], inputs, axis=0)
        steps = np.matmul(p["input"].T, embedded.transpose(0, 2, 1))
        steps += p["gate"][:, None]
        kind = np.result_type(steps, state, p["state"])
        before, new, after = (np.empty((shape[0], n, shape[1]), kind) for _ in range(3))
        gates, own = np.empty((shape[0], 2 * n, shape[1]), kind), np.empty((shape[0], 3 * n, shape[1]), kind)
        state, by_state = np.ascontiguousarray(state.T, kind), np.ascontiguousarray(p["state"].T, kind)
        some, stays = fresh.any(1), ~fresh
        for t in range(shape[0]):
            np.multiply(state, stays[t], out=before[t]) if some[t] else np.copyto(before[t], state)
            by_state.dot(before[t], out=own[t])
            gate, candidate = gates[t], new[t]
            np.add(steps[t, : 2 * n], own[t, : 2 * n], out=gate)
            np.negative(gate, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            np.multiply(gate[n:], own[t, 2 * n :], out=candidate)
            candidate += steps[t, 2 * n :]
            np.tanh(candidate, out=candidate)
            state = after[t]
            np.subtract(before[t], candidate, out=state)
            state *= gate[:n]
            state += candidate
        return state.T, (embedded, before, gates, own[:, 2 * n :], new, after)

    @staticmethod
    def _places(after):
        """States by place, step after step, with a 1 behind each for the constants."""
        steps, n, lanes = after.shape
        h = np.ones((steps, lanes, n + 1), after.dtype)
        h[:, :, :n] = after.transpose(0, 2, 1)
        return h.reshape(-1, n + 1)

    def _out(self, h, targets):
        """Log-probability of each place's target. For the way back: where the target's class is
        in the exponentials over classes (classes, places), these and their sums; and of the
        places inside of the network, class after class, their numbers, the borders of the
        classes, states, weights, words, exponentials over the class and their sums."""
        p = self.p
        of = np.where(targets < self.size, targets // CLASS_WORDS, targets - self.size + self.classes)
        chosen = of * len(h) + np.arange(len(h))
        logp, outer, sums = _exponentials(lambda: p["out"].T.dot(h.T), chosen, 0)
        borders = np.cumsum([0, *np.bincount(of, minlength=self.outputs)[: self.classes]]).tolist()
        # Small numbers are sorted by their digits.
        order = np.argsort(of.astype(np.uint16), kind="stable")[: borders[-1]]
        within = np.take(h, order, axis=0)
        words = p["word"].astype(within.dtype, copy=False)

        def by_class():
            logits = np.empty((len(order), CLASS_WORDS), within.dtype)
            for word, low, high in zip(words, borders, borders[1:]):
                if high > low:
                    within[low:high].dot(word, out=logits[low:high])
            return logits

        at = targets[order] - of[order] * CLASS_WORDS + np.arange(len(order)) * CLASS_WORDS
        inside, inner, totals = _exponentials(by_class, at, 1)
        logp[order] += inside
        return logp, (chosen, outer, sums), (order, borders, within, words, at, inner, totals)

    def log_probability(self, inputs, targets, fresh, state):
        """Natural logarithms of the targets' probabilities, and the state behind the window.
        Of a target outside of the network, that of its class."""
        end, kept = self.states(inputs, fresh, state)
        logp, *_ = self._out(self._places(kept[-1]), targets.ravel())
        return logp.reshape(targets.shape), end

    def gradients(self, inputs, targets, weight, fresh, state):
        p, n, (steps, lanes) = self.p, STATE, inputs.shape
        end, (embedded, before, gates, own, new, after) = self.states(inputs, fresh, state)
        h, y, w = self._places(after), targets.ravel(), weight.ravel().astype(np.float32)
        _, (chosen, d_outer, sums), (order, borders, within, words, at, d_inner, totals) = self._out(h, y)
        d_outer *= w / sums
        d_outer.ravel()[chosen] -= w
        g = {"out": np.ascontiguousarray(d_outer.dot(h).T), "word": np.zeros_like(words)}
        dh = d_outer.T.dot(p["out"].T)
        own_w = w[order]
        d_inner *= (own_w / totals)[:, None]
        d_inner.ravel()[at] -= own_w
        d_within = np.empty_like(within)
        for c, (low, high) in enumerate(zip(borders, borders[1:])):
            if high > low:
                within[low:high].T.dot(d_inner[low:high], out=g["word"][c])
                d_inner[low:high].dot(words[c].T, out=d_within[low:high])
        dh[order] += d_within

        # What a step sends back through its gates and candidates, for all steps at once.
        z, r = gates[:, :n], gates[:, n:]
        rest = 1 - z
        by_new = 1 - new * new
        by_new *= rest
        back = np.empty((steps, 3, n, lanes), by_new.dtype)
        np.subtract(before, new, out=back[:, 0])
        back[:, 0] *= z
        back[:, 0] *= rest
        np.multiply(by_new, r, out=back[:, 2])
        np.subtract(1, r, out=back[:, 1])
        back[:, 1] *= own
        back[:, 1] *= back[:, 2]
        d_after = np.ascontiguousarray(dh.reshape(steps, lanes, n + 1)[:, :, :n].transpose(0, 2, 1))
        d_own = np.empty_like(back)
        by_state = np.ascontiguousarray(p["state"], back.dtype)
        some, stays = fresh.any(1), ~fresh
        carried = np.zeros((n, lanes), back.dtype)
        for t in range(steps - 1, -1, -1):
            d = d_after[t]
            d += carried
            np.multiply(d, back[t], out=d_own[t])
            by_state.dot(d_own[t].reshape(3 * n, lanes), out=carried)
            carried += d * z[t]
            if some[t]:
                carried *= stays[t]
        by_lane = d_own.reshape(steps, 3 * n, lanes).transpose(0, 2, 1)
        g["state"] = np.matmul(before, by_lane).sum(0)
        np.multiply(d_after, by_new, out=d_own[:, 2])
        g["gate"] = d_own.sum((0, 3)).ravel()
        g["input"] = np.matmul(embedded.transpose(0, 2, 1), by_lane).sum(0)
        d_x = np.matmul(by_lane, p["input"].T).reshape(-1, WIDTH)
        x = inputs.ravel()
        order = np.argsort(x.astype(np.uint16) if self.size + ENDINGS < 1 << 16 else x, kind="stable")
        x = x[order]
        firsts = np.flatnonzero(np.diff(x, prepend=-1))
        g["embed"] = np.zeros_like(p["embed"])
        g["embed"][x[firsts]] = np.add.reduceat(np.take(d_x, order, axis=0), firsts, axis=0)
        return g, end


class Adam:
    def __init__(self, network: Network) -> None:
        self.network, self.t = network, 0
        # The moments, but for the factors 0.1 and 0.001.
        self.first = {k: np.zeros_like(v) for k, v in network.p.items()}
        self.second = {k: np.zeros_like(v) for k, v in network.p.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        """One step; the gradients' memory is used up."""
        self.t += 1
        rate = RATE * math.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t) * 0.1 * math.sqrt(1000)
        for name, g in gradients.items():
            all_of = [x.reshape(-1) for x in (self.network.p[name], g, self.first[name], self.second[name])]
            # Pieces that stay near the processor while they are worked on.
            for low in range(0, g.size, PIECE):
                value, slope, first, second = (x[low : low + PIECE] for x in all_of)
                first *= 0.9
                first += slope
                slope *= slope
                second *= 0.999
                second += slope
                np.sqrt(second, out=slope)
                slope += 1e-6 * math.sqrt(1000)
                np.divide(first, slope, out=slope)
                slope *= rate
                value -= slope


def train(network: Network, optimiser: Adam, documents: list[np.ndarray], end: int) -> None:
    """One pass over documents (input numbers of their words, without the end), cut into lanes."""
    inputs = np.concatenate([np.concatenate(([end], d)) for d in documents])
    targets = np.concatenate([np.append(d, end) for d in documents])
    fresh = np.zeros(len(inputs), dtype=bool)
    fresh[np.cumsum([0, *(len(d) + 1 for d in documents[:-1])])] = True
    lanes = int(min(LANES, max(1, len(inputs) // (2 * WINDOW))))
    length = -(-len(inputs) // lanes)
    spare = lanes * length - len(inputs)

    def cut(values, fill):
        return np.append(values, np.full(spare, fill, values.dtype)).reshape(lanes, length).T

    weight = cut(np.ones(len(inputs), np.float32), 0)
    inputs, targets, fresh = cut(inputs, end), cut(targets, end), cut(fresh, True)
    state = np.zeros((lanes, STATE), np.float32)
    for low in range(0, length, WINDOW):
        part = slice(low, low + WINDOW)
        share = weight[part] / max(1.0, float(weight[part].sum()))
        gradients, state = network.gradients(inputs[part], targets[part], share, fresh[part], state)
        optimiser.step(gradients)


def score(network: Network, documents: list[np.ndarray], end: int, window: int = 16) -> np.ndarray:
    """Natural log-likelihood of each whole document, the end included."""
    # As many lanes as the longest document allows to be of one length.
    sizes = [len(d) + 1 for d in documents]
    lanes = min(SCORE_LANES, len(documents), max(1, sum(sizes) // max(sizes)))
    loads = [(0, i) for i in range(lanes)]
    held: list[list[int]] = [[] for _ in range(lanes)]
    for d in sorted(range(len(documents)), key=lambda d: -len(documents[d])):
        load, lane = heapq.heappop(loads)
        held[lane].append(d)
        heapq.heappush(loads, (load + len(documents[d]) + 1, lane))
    # The longest lanes first, so that lanes that end leave from the back.
    lengths = [sum(len(documents[d]) + 1 for d in lane) for lane in held]
    order = sorted(range(lanes), key=lambda i: -lengths[i])
    longest = lengths[order[0]]
    inputs = np.full((longest, lanes), end, np.int32)
    targets = np.full((longest, lanes), end, np.int32)
    fresh = np.zeros((longest, lanes), dtype=bool)
    of = np.full((longest, lanes), len(documents), np.int32)
    for column, i in enumerate(order):
        at = 0
        for d in held[i]:
            n = len(documents[d])
            inputs[at + 1 : at + n + 1, column] = documents[d]
            targets[at : at + n, column] = documents[d]
            fresh[at, column] = True
            of[at : at + n + 1, column] = d
            at += n + 1
    ends = np.array([lengths[i] for i in order])
    total = np.zeros(len(documents) + 1)
    state = np.zeros((lanes, STATE), np.float32)
    for low in range(0, longest, window):
        there = int((ends > low).sum())
        part = (slice(low, low + window), slice(0, there))
        logp, state = network.log_probability(inputs[part], targets[part], fresh[part], state[:there])
        total += np.bincount(of[part].ravel(), logp.ravel(), len(total))
    return total[:-1]


def trained(numbered: DataFrame, lexicon_shared, rounds: int = ROUNDS) -> Network:
    """Parameters after all rounds, averaged over the tasks of each by their tokens."""
    known = lexicon_shared.value
    network = Network(known)
    size = len(network.flat())
    chunks = -(-size // CHUNK)
    spark = numbered.sparkSession
    for turn in range(rounds):
        mine = numbered.filter(F.pmod(F.xxhash64(F.lit("round"), F.col("doc_id")), F.lit(rounds)) == turn)
        start = spark.sparkContext.broadcast(network.flat())

        def learn(batches, start=start):
            words = lexicon_shared.value
            own = Network(words).load(start.value)
            optimiser, held, waiting, tokens = Adam(own), [], 0, 0
            for batch in batches:
                for document in _documents(batch.column(0)):
                    held.append(document)
                    waiting += len(document) + 1
                    if waiting >= TRAIN_TOKENS:
                        train(own, optimiser, held, words.end)
                        held, waiting, tokens = [], 0, tokens + waiting
            if held:
                train(own, optimiser, held, words.end)
            tokens += waiting
            if tokens:
                flat = np.zeros(chunks * CHUNK)
                flat[:size] = own.flat() * tokens
                rows = np.concatenate([flat.reshape(chunks, CHUNK), np.full((chunks, 1), float(tokens))], 1)
                places = np.arange(0, rows.size + 1, CHUNK + 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(chunks), pa.int32()), pa.ListArray.from_arrays(places, pa.array(rows.ravel()))],
                    names=["chunk", "values"],
                )

        sums = summed_vectors(mine.select("numbers").mapInArrow(learn, "chunk int, values array<double>")).collect()
        if sums:
            flat = np.zeros((chunks, CHUNK))
            for row in sums:
                values = np.array(row["values"])
                flat[row["chunk"]] = values[:-1] / values[-1]
            network.load(flat.ravel()[:size])
    return network


def _documents(column: pa.Array) -> list[np.ndarray]:
    """Input numbers of the words of numbered documents."""
    # An empty column may have no memory to read from.
    return [np.frombuffer(x, np.uint16) if x else np.zeros(0, np.uint16) for x in column.to_pylist()]


def _scored(shared, flat, batches):
    words = shared.value
    network = Network(words).load(flat.value)
    for table in grouped(batches, SCORE_BYTES):
        documents = [d for chunk in table.column("numbers").chunks for d in _documents(chunk)]
        logs = score(network, documents, words.end) / math.log(10)
        model = pc.add(table.column("model"), pa.array(logs))
        scored = table.set_column(table.column_names.index("model"), "model", model).drop_columns("numbers")
        yield from scored.combine_chunks().to_batches()


def _numbered(shared, batches):
    from pyspark import TaskContext

    words = shared.value
    words.prepare()
    row = TaskContext.get().partitionId() << 33
    for table in grouped(batches):
        yield _rows(words, table, row)
        row += len(table)


def _rows(words: Lexicon, table: pa.Table, row: int) -> pa.RecordBatch:
    every, places = words_of(table.column(2))
    found, numbers = words.numbers(every)
    documents, sizes = len(table), np.diff(places)
    of = np.repeat(np.arange(documents, dtype=np.int32), sizes)
    known = found >= 0
    tails = found >= words.network
    in_class = np.bincount(of[tails], words.log_in_class[found[tails] - words.network], documents)

    # Words that no task holds, once for a document.
    others = every.filter(pa.array(~known)).dictionary_encode()
    distinct = len(others.dictionary)
    pairs, times = np.unique(
        of[~known].astype(np.int64) * max(distinct, 1) + others.indices.to_numpy(), return_counts=True
    )
    document, word = pairs // max(distinct, 1), pairs % max(distinct, 1)
    endings = np.array([ending(w) for w in others.dictionary.to_pylist()], np.int32)
    rest = pa.StructArray.from_arrays(
        [others.dictionary.cast(pa.binary()).take(pa.array(word)), pa.array(endings[word]), pa.array(times, pa.int32())],
        names=["word", "ending", "n"],
    )
    borders = np.searchsorted(document, np.arange(documents + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(row, row + documents)),
            table.column(0).combine_chunks(),
            table.column(1).combine_chunks(),
            pa.array(sizes + 1),
            pa.array(np.bincount(of[known], minlength=documents) + (words.ends > 0)),
            pa.array(np.bincount(of[known], words.log_base[found[known]], documents) + words.log_base_end),
            pa.array(in_class, pa.float64()),
            pa.ListArray.from_arrays(borders, rest),
            pa.Array.from_buffers(
                pa.binary(), documents, [None, pa.py_buffer((2 * places).astype(np.int32)), pa.py_buffer(numbers)]
            ),
        ],
        names="row,doc_id,held_out,n_tokens,n_known,base,model,rest,numbers".split(","),
    )


def likelihood(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Learned from documents whose crc32(doc_id) modulo PARTS is not PART. Tokens are the words
    and one end. ``base_score`` is that of the smoothed counts, ``score`` the network's log10
    probability of the whole text. Unseen words have the share of one word with no count.

    Null texts are empty and have the end alone. Rows without an id are scored and not learned
    from; repeated rows are counted and scored each; long texts are scored with one state from
    begin to end. If there is nothing to learn from, every token is unseen, and the score that
    of the untrained network. An empty table gives an empty table. Other columns are not read.
    """
    spark = docs.sparkSession
    given = docs.select(
        F.col("doc_id").cast("long"), held_out("doc_id", PARTS, PART).alias("held_out"), "text"
    )
    learn = given.filter("NOT held_out AND doc_id IS NOT NULL")
    counts = pinned(word_counts(learn))
    known = lexicon(counts, learn.count())
    shared = spark.sparkContext.broadcast(known)
    numbered = pinned(given.mapInArrow(lambda batches: _numbered(shared, batches), NUMBERED))
    lessons = numbered.filter("NOT held_out AND doc_id IS NOT NULL")
    flat = spark.sparkContext.broadcast(trained(lessons, shared).flat())
    numbers = numbered.drop("rest")
    scored = pinned(numbers.mapInArrow(lambda batches: _scored(shared, flat, batches), KEYS))

    # Words that no task holds: their counts come by a join.
    rest = numbered.select("row", F.explode("rest").alias("r")).select(
        "row", "r.word", "r.ending", F.col("r.n").alias("times")
    )
    floor = F.lit(math.log10(known.total + known.distinct + 1))
    classes = F.array(*(F.lit(float(math.log10(x + 1))) for x in known.class_total + known.class_distinct))
    seen = F.log10(F.coalesce("n", F.lit(0)) + 1.0)
    added = (
        rest.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
            F.sum(F.col("times") * (seen - floor)).alias("more_base"),
            F.sum(F.col("times") * (seen - F.element_at(classes, F.col("ending") + 1))).alias("more_model"),
        )
    )

    def plus(a, b):
        return F.col(a) + F.coalesce(F.col(b), F.lit(0))

    return scored.join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        plus("n_known", "more_known").alias("n_known"),
        F.lit(int(known.total)).cast("long").alias("train_tokens"),
        plus("base", "more_base").alias("base_score"),
        plus("model", "more_model").alias("score"),
    )
