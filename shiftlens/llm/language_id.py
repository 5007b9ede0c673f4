"""Language identification by a bidirectional gated recurrent network over bytes.

A text is lower-cased and read as UTF-8 in segments of ``SEGMENT`` bytes. Two
gated recurrent units of ``HIDDEN`` cells read a segment forwards and backwards;
their states at a position give that position's probability of each language.
A document's probability is the mean over the positions of its letters. The
network is written in numpy and trained by backpropagation through time.

Training uses a bounded sample of the labelled rows that are not held out: at
most ``LANG_DOCS`` different texts of a language (those with the smallest hash), ``DOC_SEGMENTS`` segments
of each, spread over the whole text, and at most ``MAX_LANGS`` languages (the most frequent
ones). It runs on Spark in rounds: ``REPLICAS`` tasks train the same network on
their parts of the sample, then their parameters and moments are averaged. What
passes through the driver is a network of fixed size per replica and round.

Prediction covers every byte of every text, in blocks of ``BLOCK`` segments: memory
does not depend on a text's length. Which rows are held out depends on the
id alone: the CRC-32 of its decimal text, remainder 1 by 3 (a null id counts as
an empty text, which is not held out). A prediction sees the text only.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is
every text if there is nothing to learn from; ties go to the language that
sorts first; repeated rows get equal answers; copies count once in
training; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, stored, table

HIDDEN, SEGMENT, BLOCK = 12, 128, 1024
LANG_DOCS, DOC_SEGMENTS, TRAIN_SEGMENT, MAX_LANGS = 400, 8, 64, 256
REPLICAS, ROUNDS, STEPS, BATCH, RATE = 4, 4, 50, 128, 0.01
WINDOW = 1 << 18  # bytes of a text that are lower-cased at a time
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


# -- the network: parameters are one flat float32 vector --

def shapes(langs: int, hidden: int = HIDDEN) -> list[tuple]:
    """Input table with bias, recurrent weights (both a direction: update, reset, candidate), output, bias."""
    return [(2, 256, 3 * hidden), (2, hidden, 3 * hidden), (2, hidden, langs), (langs,)]


def unpack(flat, langs: int, hidden: int = HIDDEN) -> list:
    out, at = [], 0
    for shape in shapes(langs, hidden):
        size = 1
        for s in shape:
            size *= s
        out.append(flat[at:at + size].reshape(shape))
        at += size
    return out


def initial(langs: int, hidden: int = HIDDEN, seed: int = 13):
    import numpy as np

    rng = np.random.default_rng(seed)
    parts = [rng.standard_normal(s) * k for s, k in zip(shapes(langs, hidden), (0.3, hidden**-0.5, 0.3, 0.0))]
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


def _sides(data, length):
    """Both reading directions (2, steps, segments); the padding is last in both. Also where the backward reader
    meets each position."""
    import numpy as np

    steps = data.shape[1]
    back = np.maximum(length[:, None] - 1 - np.arange(steps), 0)
    both = np.stack([data, np.take_along_axis(data, back, 1)]).transpose(0, 2, 1)
    return both.astype(np.intp, order="C"), back.T


def _softmax(states, backward, leave, bias):
    """(langs, positions) from the two readers' states (positions, hidden)."""
    import numpy as np

    out = np.ascontiguousarray((states @ leave[0] + backward @ leave[1] + bias).T)
    out -= out.max(axis=0)
    np.exp(out, out=out)
    out /= out.sum(axis=0)
    return out


def forward(flat, data, length, langs: int, hidden: int = HIDDEN):
    """(probabilities (langs, positions), what backpropagation needs). ``data`` is (segments, steps) of bytes;
    positions go step by step, for all segments."""
    import numpy as np

    enter, again, leave, bias = unpack(flat, langs, hidden)
    sides, back = _sides(data, length)
    steps, n = data.shape[1], len(data)
    states = np.zeros((steps + 1, 2, n, hidden), flat.dtype)
    kept = []
    for t in range(steps):
        state = states[t]
        a = np.stack([enter[0][sides[0, t]], enter[1][sides[1, t]]])
        g = state @ again
        gates = 0.5 + 0.5 * np.tanh(0.5 * (a[..., :2 * hidden] + g[..., :2 * hidden]))  # the logistic function
        update, reset = gates[..., :hidden], gates[..., hidden:]
        new = np.tanh(a[..., 2 * hidden:] + reset * g[..., 2 * hidden:])
        kept.append((update, reset, new, g[..., 2 * hidden:]))
        states[t + 1] = new + update * (state - new)
    backward = np.take_along_axis(states[1:, 1], back[:, :, None], 0)
    prob = _softmax(states[1:, 0].reshape(-1, hidden), backward.reshape(-1, hidden), leave, bias)
    return prob, (sides, back, states, backward, kept)


def label_positions(flat, data, length, langs: int, hidden: int = HIDDEN):
    """``forward`` without what backpropagation needs: the same probabilities, several times as fast. The halves
    of the logistic function are put into the parameters, and every step works in place."""
    import numpy as np

    enter, again, leave, bias = unpack(flat, langs, hidden)
    sides, back = _sides(data, length)
    steps, n = data.shape[1], len(data)
    states = np.zeros((2, steps + 1, n, hidden), flat.dtype)
    gates, g_gates = np.empty((2, n, 2 * hidden), flat.dtype)
    new, g_new, apart = np.empty((3, n, hidden), flat.dtype)
    for side in (0, 1):
        in_gates = np.ascontiguousarray(enter[side][:, :2 * hidden]) * flat.dtype.type(0.5)
        in_new = np.ascontiguousarray(enter[side][:, 2 * hidden:])
        on_gates, on_new = (np.ascontiguousarray(x) * flat.dtype.type(0.5) for x in
                            (again[side][:, :2 * hidden], again[side][:, 2 * hidden:]))
        for t in range(steps):
            state, out, byte = states[side, t], states[side, t + 1], sides[side, t]
            np.take(in_gates, byte, axis=0, out=gates, mode="clip")
            np.matmul(state, on_gates, out=g_gates)
            gates += g_gates
            np.tanh(gates, out=gates)
            np.take(in_new, byte, axis=0, out=new, mode="clip")
            np.matmul(state, on_new, out=g_new)
            new += g_new
            g_new *= gates[:, hidden:]
            new += g_new
            np.tanh(new, out=out)
            np.subtract(state, out, out=apart)
            apart *= 0.5
            out += apart
            apart *= gates[:, :hidden]
            out += apart
    if (length == steps).all():
        backward = states[1, 1:][::-1]
    else:
        backward = np.take_along_axis(states[1, 1:], back[:, :, None], 0)
    return _softmax(states[0, 1:].reshape(-1, hidden), backward.reshape(-1, hidden), leave, bias)


def gradient(flat, data, length, weight, label, langs: int, hidden: int = HIDDEN):
    """(loss, gradient): cross-entropy over positions by ``weight`` (segments, steps), through time."""
    import numpy as np

    enter, again, leave, _ = unpack(flat, langs, hidden)
    prob, (sides, back, states, backward, kept) = forward(flat, data, length, langs, hidden)
    steps, n = data.shape[1], len(data)
    prob = prob.T.reshape(steps, n, langs)
    w = (weight / max(float(weight.sum()), 1.0)).T.astype(flat.dtype)
    picked = prob[:, np.arange(n), label]
    loss = float(-(w * np.log(np.maximum(picked, 1e-12))).sum())
    d = prob * w[:, :, None]
    d[:, np.arange(n), label] -= w
    flat_d = d.reshape(-1, langs)
    d_leave = np.stack([states[1:, 0].reshape(-1, hidden).T @ flat_d, backward.reshape(-1, hidden).T @ flat_d])
    d_bias = flat_d.sum(axis=0)
    into = np.zeros((steps, 2, n, hidden), flat.dtype)
    into[:, 0] = d @ leave[0].T
    d_back = d @ leave[1].T
    valid = np.arange(steps)[:, None] < length  # positions beyond a segment's end carry no weight
    at, who = np.nonzero(valid)
    into[back[at, who], 1, who] = d_back[at, who]
    d_again = np.zeros_like(again)
    d_in = np.empty((steps, 2, n, 3 * hidden), flat.dtype)
    carry = np.zeros((2, n, hidden), flat.dtype)
    for t in range(steps - 1, -1, -1):
        update, reset, new, g_new = kept[t]
        before = states[t]
        dh = carry + into[t]
        d_new = dh * (1 - update) * (1 - new * new)
        d_update = dh * (before - new) * update * (1 - update)
        d_reset = d_new * g_new * reset * (1 - reset)
        d_in[t] = np.concatenate([d_update, d_reset, d_new], axis=2)
        d_g = np.concatenate([d_update, d_reset, d_new * reset], axis=2)
        d_again += before.transpose(0, 2, 1) @ d_g
        carry = dh * update + d_g @ again.transpose(0, 2, 1)
    d_enter = np.zeros_like(enter)
    for side in (0, 1):
        byte = sides[side].ravel()
        order = np.argsort(byte, kind="stable")
        rows = d_in[:, side].reshape(-1, 3 * hidden)[order]
        first = np.flatnonzero(np.diff(byte[order].astype(np.int64), prepend=-1))
        d_enter[side, byte[order][first]] = np.add.reduceat(rows, first, axis=0)
    return loss, np.concatenate([x.ravel() for x in (d_enter, d_again, d_leave, d_bias)])


def improve(state, data, length, weight, label, langs: int, rng, steps: int = STEPS, step0: int = 0,
            batch: int = BATCH, rate: float = RATE):
    """``steps`` steps of Adam on batches that hold every language alike; ``state`` is (parameters, moments 1, moments 2)."""
    import numpy as np

    flat, m, v = (x.copy() for x in state)
    chance = (1 / np.maximum(np.bincount(label, minlength=langs), 1))[label]
    chance /= chance.sum()
    for step in range(step0 + 1, step0 + steps + 1):
        own = rng.choice(len(label), min(batch, len(label)), p=chance)
        _, g = gradient(flat, data[own], length[own], weight[own], label[own], langs)
        g *= min(1.0, 1.0 / max(float(np.sqrt((g * g).sum())), 1e-12))
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        flat -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(flat.dtype)
    return flat, m, v


def letters(data):
    """Which bytes of lower-cased UTF-8 count as letters."""
    return (data >= 97) & (data <= 122) | (data >= 128)


def padded(parts: list[bytes], steps: int):
    import numpy as np

    length = np.array([len(p) for p in parts], np.int64)
    data = np.frombuffer(b"".join(p.ljust(steps, b"\0") for p in parts), np.uint8).reshape(len(parts), steps)
    return data, length, letters(data)


def lowered(data: bytes, window: int = WINDOW) -> Iterator[tuple[bytes, bool]]:
    """(lower-cased UTF-8, whether it has a letter) of the text in parts that end between characters."""
    at = 0
    while at < len(data):
        end = min(at + window, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        text = data[at:end].decode("utf-8", "replace").lower()
        yield text.encode("utf-8", "replace"), _LETTER.search(text) is not None
        at = end


# -- Spark --

def held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def sample(rows: DataFrame, lang_docs: int = LANG_DOCS, max_langs: int = MAX_LANGS) -> DataFrame:
    """(label, lang, h, text): at most ``lang_docs`` different texts of each language."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("h", F.xxhash64("text"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    langs = sizes.orderBy(F.desc("n"), "lang").limit(max_langs)
    langs = langs.withColumn("label", F.row_number().over(Window.orderBy("lang")) - 1)  # at most max_langs rows
    # about four times the wanted texts pass by their hash, so that few of them are ranked
    low = F.col("h") / F.lit(2.0**64) + 0.5 < F.lit(4.0 * lang_docs) / F.col("n")
    near = rows.join(F.broadcast(langs), "lang").where(low)
    once = near.groupBy("lang", "label", "h").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    return once.withColumn("r", rank).where(F.col("r") <= lang_docs).select("label", "lang", "h", "text")


def segments(picked: DataFrame, per_doc: int = DOC_SEGMENTS, steps: int = TRAIN_SEGMENT) -> DataFrame:
    """(replica, label, h, part, bytes): ``per_doc`` segments of each text, spread over the whole of it; stored."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            label, key, part, out = [], [], [], []
            for i in range(batch.num_rows):
                data = b"".join(p for p, _ in lowered(batch.column("text")[i].as_buffer().to_pybytes()))
                last = max(0, len(data) - steps)
                starts = sorted({last * k // max(1, per_doc - 1) for k in range(per_doc)})
                for k, at in enumerate(starts):
                    if data and letters_in(data[at:at + steps]):
                        label.append(batch.column("label")[i].as_py())
                        key.append(batch.column("h")[i].as_py())
                        part.append(k)
                        out.append(data[at:at + steps])
            yield pa.RecordBatch.from_arrays(
                [pa.array([k % REPLICAS for k in key], pa.int32()), pa.array(label, pa.int32()), pa.array(key, pa.int64()),
                 pa.array(part, pa.int32()), pa.array(out, pa.binary())], ["replica", "label", "h", "part", "bytes"])

    return stored(picked.select("label", "h", "text").mapInArrow(
        run, "replica int, label int, h bigint, part int, bytes binary"), "language-segments")


def letters_in(data: bytes) -> bool:
    import numpy as np

    return bool(letters(np.frombuffer(data, np.uint8)).any())


def _round(before: bytes, turn: int, place: dict[int, int]):
    """One replica's part of a round: a function of its segments, which gives its new parameters and moments."""

    def run(rows):
        import numpy as np
        import pyarrow as pa

        order = rows.sort_by([("h", "ascending"), ("part", "ascending"), ("label", "ascending")])
        data, length, weight = padded(order.column("bytes").to_pylist(), TRAIN_SEGMENT)
        label = np.array([place[x] for x in order.column("label").to_pylist()])
        replica = order.column("replica")[0].as_py()
        done = improve(np.frombuffer(before, np.float32).reshape(3, -1), data, length, weight, label, len(place),
                       np.random.default_rng([13, turn, replica]), step0=turn * STEPS, rate=RATE * (1 - turn / ROUNDS))
        return pa.table({"replica": pa.array([replica], pa.int32()), "n": [len(label)],
                         "state": [np.concatenate(done).tobytes()]})

    return run


def train(rows: DataFrame) -> tuple[list[str], bytes]:
    """(languages, parameters) learned from (lang, text); no languages if there is nothing to learn from."""
    import numpy as np

    picked = stored(sample(rows), "language-sample")
    known = picked.select("lang", "label").distinct().orderBy("label").collect()  # at most MAX_LANGS rows
    langs, place = [r["lang"] for r in known], {r["label"]: i for i, r in enumerate(known)}
    if not langs:
        return [], b""
    parts = segments(picked)
    flat = initial(len(langs))
    state = (flat, np.zeros_like(flat), np.zeros_like(flat))
    for turn in range(ROUNDS if len(langs) > 1 else 0):
        told = sorted(parts.repartitionByRange(REPLICAS, "replica").groupBy("replica").applyInArrow(
            _round(np.concatenate(state).tobytes(), turn, place), "replica int, n bigint, state binary").collect())
        share = np.array([r["n"] for r in told], float)  # REPLICAS rows
        each = np.stack([np.frombuffer(r["state"], np.float32) for r in told])
        state = tuple((each * (share / share.sum())[:, None]).sum(axis=0).astype(np.float32).reshape(3, -1))
    return langs, state[0].tobytes()


def predict(docs: DataFrame, langs: list[str], params: bytes) -> DataFrame:
    """(id, held_out, lang_pred, score) for every row of (id, held_out, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        flat = np.frombuffer(params, np.float32)

        def add(total, parts: list[bytes], owner: list[int]):
            order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
            for at in range(0, len(order), BLOCK):
                own = order[at:at + BLOCK]
                data, length, weight = padded([parts[i] for i in own], max(len(parts[i]) for i in own))
                prob = label_positions(flat, data, length, len(langs))
                prob *= weight.T.ravel()
                mean = prob.reshape(len(langs), -1, len(own)).sum(axis=1, dtype=np.float64).T
                np.add.at(total, np.array([owner[i] for i in own]), np.column_stack([mean, weight.sum(axis=1)]))

        for batch in batches:
            texts = batch.column("text")
            total = np.zeros((batch.num_rows, len(langs) + 1))
            has = np.zeros(batch.num_rows, bool)
            parts, owner = [], []
            for i in range(batch.num_rows if langs else 0):
                if not texts[i].is_valid:
                    continue
                for data, letter in lowered(texts[i].as_buffer().to_pybytes()):
                    has[i] |= letter
                    cut = [data[at:at + SEGMENT] for at in range(0, len(data), SEGMENT)]
                    parts += cut
                    owner += [i] * len(cut)
                    if len(parts) >= 8 * BLOCK:
                        add(total, parts, owner)
                        parts, owner = [], []
            if parts:
                add(total, parts, owner)
            known = has & (total[:, -1] > 0)
            mean = total[:, :-1] / np.maximum(total[:, -1:], 1)
            best = mean.argmax(axis=1) if langs else np.zeros(batch.num_rows, int)
            score = np.where(known, mean.max(axis=1, initial=0), 0.0).clip(0, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"),
                 pa.array([langs[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()), pa.array(score)],
                ["id", "held_out", "lang_pred", "score"])

    return docs.select("id", "held_out", "text").mapInArrow(
        run, f"id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score): learned from the rows that are not held out, predicted for all."""
    src = pick(docs, id=id_col, text=text_col, lang=lang_col).withColumn("held_out", held_out("id"))
    langs, params = train(src.where(~F.col("held_out")).select("lang", "text"))
    return predict(src, langs, params)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
