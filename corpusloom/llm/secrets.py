"""Secret scan: fixed patterns, and a character convolutional network over further candidates.

The patterns give the base findings, which always stay. Every other run of key-like
characters with a digit in it is a candidate; a small network reads its characters and
those around it. It is trained on labelled findings: all different candidates of the
documents, labelled by the patterns, and generated keys and harmless look-alikes. Shards
of the findings are learned from at once, and the weights averaged after each epoch. Its
outputs are calibrated on a quarter of all findings kept aside, and the threshold is the
highest at which the asked share of the labelled secrets there is still found.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import free_name, let_go, staged, texts
from corpusloom.operators.cutoff import nth_key

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS, ACCESS_LEAST = re.compile(r"AKIA[A-Z0-9]+"), 16
HEX, HEX_LEAST = re.compile(r"[0-9a-f]+"), 32
ASSIGN_LEAST = 8
KINDS = ("assign", "access", "hex", "net")

# Candidates are maximal runs of these characters with at least one digit.
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")

# The window that the network reads: context, head and tail of the candidate, context.
BEFORE, HEAD, TAIL, AFTER = 24, 32, 12, 8
PLACES = BEFORE + HEAD + TAIL + AFTER
# Findings that one task learns from, about; generated findings, which every shard sees besides.
SHARD = 8_192
GENERATED = 3_000
RECALL = 0.98
LEAST_PROBABILITY = 0.5
FILTERS, WIDTH, EMBED, EPOCHS, BATCH = 24, 5, 10, 6, 128
SCORED = 2_048

_CLASSES = string.ascii_letters + string.digits + " \n\"'=:+/_.-,;()[]{}<>@#$%&*!?|\\"
_CODE = {c: i + 2 for i, c in enumerate(_CLASSES)}  # 0: nothing, 1: any other character
CODES = len(_CLASSES) + 2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base findings, by start, then kind."""
    found = []
    lower = text.lower()
    if any(w in lower for w in WORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    for run in RUN.finditer(text):  # both other kinds lie within such a run
        a, b = run.span()
        for number, pattern, least in ((1, ACCESS, ACCESS_LEAST), (2, HEX, HEX_LEAST)):
            found += [(*m.span(), number) for m in pattern.finditer(text, a, b) if m.end() - m.start() >= least]
    return sorted(found, key=lambda s: (s[0], s[2]))


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of key-like characters with a digit; marks at their ends are left out."""
    found = []
    for run in RUN.finditer(text):
        a, b = run.span()
        while b > a and text[b - 1] in ".=-_/+":
            b -= 1
        while a < b and text[a] in ".=-_/+":
            a += 1
        if b - a >= 16 and any(c.isdigit() for c in text[a:b]):
            found.append((a, b))
    return found


def free_candidates(text: str, base: Sequence[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Candidates that no base finding touches; both lists are in order."""
    found, at, reach = [], 0, 0
    for a, b in candidates(text):
        while at < len(base) and base[at][0] < b:
            reach = max(reach, base[at][1])
            at += 1
        if reach <= a:
            found.append((a, b))
    return found


def window(text: str, start: int, end: int) -> str:
    """What the network reads of a candidate, one character a place; a NUL fills gaps."""
    whole = text[start:end]
    head, tail = whole[:HEAD], whole[HEAD:][-TAIL:]
    before, after = text[max(0, start - BEFORE) : start], text[end : end + AFTER]
    return before.rjust(BEFORE, "\0") + head.ljust(HEAD, "\0") + tail.ljust(TAIL, "\0") + after.ljust(AFTER, "\0")


def encode(windows: Sequence[str]) -> np.ndarray:
    """Character classes of windows."""
    return np.array([[0 if c == "\0" else _CODE.get(c, 1) for c in w] for w in windows], np.int64).reshape(-1, PLACES)


@dataclass
class Network:
    """Embedding, one convolution, largest and mean response of each filter, one output; with its calibration."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = LEAST_PROBABILITY

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out, self.out_bias]

    def _slices(self, codes: np.ndarray) -> np.ndarray:
        """Embedded characters, WIDTH at a time: (windows, places, WIDTH * EMBED)."""
        given = self.embed[codes]
        return np.concatenate([given[:, i : PLACES - WIDTH + 1 + i] for i in range(WIDTH)], axis=2)

    def forward(self, codes: np.ndarray):
        slices = self._slices(codes)
        local = np.maximum(slices @ self.filters + self.bias, 0)
        top = local.argmax(axis=1)
        best = np.take_along_axis(local, top[:, None], 1)[:, 0]
        pooled = np.concatenate([best, local.mean(axis=1)], axis=1)
        return slices, local, top, pooled, pooled @ self.out + self.out_bias[0]

    def logits(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [self.forward(codes[i : i + SCORED])[-1] for i in range(0, len(codes), SCORED)] or [np.zeros(0)]
        )

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Calibrated probabilities that the candidates are secrets."""
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(codes) + self.shift, -40, 40)))


def _start(draw: np.random.Generator) -> Network:
    return Network(
        draw.normal(0, 0.3, (CODES, EMBED)),
        draw.normal(0, 0.2, (WIDTH * EMBED, FILTERS)),
        np.zeros(FILTERS),
        draw.normal(0, 0.2, 2 * FILTERS),
        np.zeros(1),
    )


def _learn(
    net: Network, codes: np.ndarray, labels: np.ndarray, draw: np.random.Generator, epochs: int,
    moments: list[np.ndarray] | None = None, step: int = 0,
) -> Network:
    """Trains the convolution with Adam on logistic loss, in place; ``moments`` go on from ``step``."""
    held = net.weights
    moments = moments or [np.zeros_like(h) for h in [*held, *held]]
    means, squares = moments[: len(held)], moments[len(held) :]
    width = PLACES - WIDTH + 1
    for _ in range(epochs):
        order = draw.permutation(len(codes))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            slices, local, top, pooled, logit = net.forward(codes[part])
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[part]) / len(part)
            back = error[:, None] * net.out
            spread = np.repeat(back[:, None, FILTERS:] / width, width, axis=1)
            rows, cols = np.indices(top.shape)
            spread[rows, top, cols] += back[:, :FILTERS]
            spread *= local > 0
            flat = spread.reshape(-1, FILTERS)
            to_slices = (spread @ net.filters.T).reshape(len(part), width, WIDTH, EMBED)
            slope_embed = np.zeros_like(net.embed)
            for i in range(WIDTH):
                where = codes[part][:, i : i + width].ravel()
                piece = to_slices[:, :, i].reshape(-1, EMBED)
                for e in range(EMBED):
                    slope_embed[:, e] += np.bincount(where, piece[:, e], CODES)
            slopes = [
                slope_embed,
                slices.reshape(-1, WIDTH * EMBED).T @ flat,
                flat.sum(axis=0),
                pooled.T @ error,
                np.array([error.sum()]),
            ]
            step += 1
            for value, slope, mean, square in zip(held, slopes, means, squares):
                mean += 0.1 * (slope - mean)
                square += 0.001 * (slope**2 - square)
                value -= 0.004 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return net


Sums = Callable[[float, float], np.ndarray]


def _steps(logit: np.ndarray, labels: np.ndarray, aims: tuple[float, float]) -> Sums:
    """Sums over calibration rows, given scale and shift: errors, errors by logit, bends, by logit, by its square."""
    aim = np.where(labels > 0, aims[1], aims[0])

    def sums(scale: float, shift: float) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(scale * logit + shift, -40, 40)))
        bend = p * (1 - p) + 1e-9
        return np.array([(p - aim).sum(), (logit * (p - aim)).sum(), bend.sum(), (logit * bend).sum(), (logit**2 * bend).sum()])

    return sums


def _steps_of_rows(rows: DataFrame, aims: tuple[float, float]) -> Sums:
    """The same over a table of logit and label; five numbers come back."""

    def sums(scale: float, shift: float) -> np.ndarray:
        z, top = F.lit(scale) * F.col("logit") + F.lit(shift), F.lit(40.0)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(z, top), -top)))
        error = p - F.when(F.col("label") > 0, F.lit(aims[1])).otherwise(F.lit(aims[0]))
        terms = rows.select("logit", error.alias("e"), (p * (1 - p) + 1e-9).alias("b"))
        found = terms.agg(*[F.sum(F.expr(t)) for t in ("e", "logit * e", "b", "logit * b", "logit * logit * b")]).first()
        return np.array([v or 0.0 for v in found])

    return sums


def _aims(secrets: int, harmless: int) -> tuple[float, float]:
    """What harmless findings and secrets should come to (Platt)."""
    return 1 / (harmless + 2), (secrets + 1) / (secrets + 2)


def _scale(net: Network, parts: Sequence[Sums]) -> None:
    """Fits scale and shift of the logits by Newton steps, held short: sure logits bend too little to be followed far."""
    value = np.array([1.0, 0.0])
    for _ in range(40):
        e, le, b, lb, llb = sum(part(float(value[0]), float(value[1])) for part in parts)
        slope = np.array([le, e]) + 1e-3 * (value - [1.0, 0.0])
        step = np.linalg.solve(np.array([[llb, lb], [lb, b]]) + 1e-3 * np.eye(2), slope)
        step = step * min(1.0, value[0] / 2 / max(abs(step[0]), 1e-300), 4 / max(abs(step[1]), 1e-300))
        value = value - step
        if np.abs(step).max() < 1e-9:
            break
    net.scale, net.shift = float(value[0]), float(value[1])


def _calibrate(net: Network, codes: np.ndarray, labels: np.ndarray, recall: float) -> Network:
    """Fits scale and shift of the logits, then sets the recall-constrained threshold."""
    secrets = int(labels.sum())
    _scale(net, [_steps(net.logits(codes), labels, _aims(secrets, len(labels) - secrets))])
    found = np.sort(net.probabilities(codes[labels > 0]))
    allowed = int((1 - recall) * len(found))
    net.threshold = max(LEAST_PROBABILITY, float(found[allowed]) - 1e-9) if len(found) else LEAST_PROBABILITY
    return net


def generated(count: int, seed: int) -> list[tuple[str, int]]:
    """Labelled windows made up by rule: keys after telling words, and numbers, dates, paths, addresses and names."""
    draw = random.Random(seed)
    syllables = ["ta", "re", "on", "il", "mo", "ven", "sur", "ka", "pel", "dor", "is", "un", "ech", "lan"]

    def word() -> str:
        return "".join(draw.choices(syllables, k=draw.randint(1, 4)))

    def of(letters: str, low: int, high: int) -> str:
        value = "".join(draw.choices(letters, k=draw.randint(low, high)))
        return value + draw.choice(string.digits)

    mixed, found = string.ascii_letters + string.digits, []
    for _ in range(count):
        secret = draw.random() < 0.5
        if secret:
            body = draw.choice([
                lambda: of(string.hexdigits.lower(), 24, 64),
                lambda: of(mixed, 20, 48),
                lambda: of(mixed + "+/", 30, 60) + draw.choice(["", "=", "=="]),
                lambda: draw.choice(["sk_live_", "ghp_", "xoxb-", "key-", "pk_"]) + of(mixed, 20, 36),
                lambda: "eyJ" + of(mixed, 20, 30) + "." + of(mixed + "-_", 20, 40),
            ])()
            lead = draw.choice(["auth ", "Authorization: Bearer ", "key ", "credential = ", "pwd=", "private_key: \"", word() + " ", "secret is ", "token ", "access_key '"])
        else:
            body = draw.choice([
                lambda: "".join(draw.choices(string.digits, k=draw.randint(16, 20))),
                lambda: f"{draw.randint(1900, 2100)}-{draw.randint(10, 12)}-{draw.randint(10, 28)}.{word()}-{word()}",
                lambda: "/".join(word() for _ in range(4)) + f"/{word()}{draw.randint(1, 99)}.txt",
                lambda: f"www.{word()}{word()}{draw.randint(1, 99)}.com/{word()}/{word()}",
                lambda: f"{word()}_{word()}_{word()}_{word()}_{draw.randint(1, 99)}".ljust(16, "x"),
                lambda: f"{word()}-{word()}-{word()}-{word()}-{word()}{draw.randint(1, 9)}".ljust(16, "x"),
                lambda: ".".join(str(draw.randint(100, 255)) for _ in range(4)) + ".0.0",
                lambda: (word() + word() + word() + word()).ljust(16, "a") + str(draw.randint(1, 9)),
                lambda: "=" * draw.randint(8, 20) + str(draw.randint(1, 9)) + "-" * 10,
            ])()
            lead = draw.choice(["see ", "on ", "at ", "file ", "number ", "id: ", "http://", word() + " ", word() + ". ", "version "])
        text = f"{word()} {word()} {word()} {lead}"
        found.append((window(text + body + draw.choice([" ", "\n", '" ', ". "]) + word() + " " + word(), len(text), len(text) + len(body)), int(secret)))
    return found


def findings(docs: DataFrame) -> DataFrame:
    """Every different candidate of the documents as (seen, label), labelled by the patterns; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            rows: list[tuple[str, int]] = []
            for text in texts(batch):
                base = base_spans(text)
                rows += [(window(text, a, b), 0) for a, b in free_candidates(text, base)]
                rows += [(window(text, a, b), 1) for a, b, _ in base]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], ["seen", "label"]
            )

    labelled = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "seen string, label int")
    return staged(labelled.distinct(), "findings")  # a few words of context each


def _logits(net: Network, rows: DataFrame) -> DataFrame:
    """``rows`` (seen, label) with the network's logit; staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            logit = net.logits(encode(batch.column("seen").to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logit, pa.float64())], ["seen", "label", "logit"])

    return staged(rows.select("seen", "label").mapInArrow(run, "seen string, label int, logit double"), "logits")


def train_on(found: DataFrame, recall: float = RECALL, seed: int = 11, shard: int = SHARD) -> Network:
    """A calibrated network from all rows of ``found`` (seen, label) and generated windows.

    No more findings than one shard has are learned in one place (``train``). Of more, a quarter, by hash, is kept aside
    for calibration, and the others are dealt by hash to shards of about ``shard`` rows; in each epoch all shards learn
    from the same state, and their states are averaged by rows. A task holds one shard; the driver gets some 6,000
    numbers of each (50 MB for eight million findings), and sums over the part aside.
    """
    number = F.xxhash64("seen", F.lit(seed))
    if found.count() <= shard:
        every = found.withColumn("number", number).orderBy("label", "number", "seen").collect()
        return train([(r["seen"], r["label"]) for r in every], recall, seed)
    made = generated(GENERATED, seed)
    own, kept = made[: GENERATED * 3 // 4], made[GENERATED * 3 // 4 :]
    aside = F.pmod(number, F.lit(4)) == 3
    learned = found.where(~aside)
    shards = learned.count() // shard + 1
    learned = learned.select("seen", "label", F.pmod(F.xxhash64("seen", F.lit(seed + 1)), F.lit(shards)).alias("shard"))
    net = _start(np.random.default_rng(seed))
    state = [*net.weights, *(np.zeros_like(w) for _ in range(2) for w in net.weights)]  # with both moments

    for turn in range(EPOCHS):

        def work(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            let_go()
            rows, part = [*sorted(zip(frame["seen"], frame["label"])), *own], [value.copy() for value in state]
            codes, labels = encode([r[0] for r in rows]), np.array([r[1] for r in rows], float)
            kinds = len(part) // 3
            draw, step = np.random.default_rng([seed, turn, int(key[0])]), turn * -(-len(rows) // BATCH)
            _learn(Network(*part[:kinds]), codes, labels, draw, 1, part[kinds:], step)
            flat = np.concatenate([value.ravel() for value in part])
            return pd.DataFrame({"shard": [int(key[0])], "rows": [len(rows)], "state": [flat]})

        got = learned.groupBy("shard").applyInPandas(work, "shard long, rows long, state array<double>").collect()
        got.sort(key=lambda r: r["shard"])
        mean, at = sum(r["rows"] * np.array(r["state"]) for r in got) / sum(r["rows"] for r in got), 0
        for value in state:
            value[...] = mean[at : at + value.size].reshape(value.shape)
            at += value.size

    logits = _logits(net, found.where(aside))
    codes, labels = encode([w for w, _ in kept]), np.array([n for _, n in kept], float)
    mine = net.logits(codes)
    counts = logits.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    secrets = counts[1] + int(labels.sum())
    aims = _aims(secrets, counts[0] + len(labels) - secrets)
    _scale(net, [_steps(mine, labels, aims), _steps_of_rows(logits, aims)])
    # The row that may be the first to be found, of all secrets kept aside.
    more = [(w, float(z)) for (w, label), z in zip(kept, mine) if label]
    known = logits.where("label = 1").select("seen", "logit").unionByName(found.sparkSession.createDataFrame(more, "seen string, logit double"))
    known = known.select((F.lit(net.scale) * F.col("logit") + F.lit(net.shift)).alias("z"), F.monotonically_increasing_id().alias("row"))
    known = staged(known, "secrets")
    total = known.count()
    least = nth_key(known, ["z", "row"], int((1 - recall) * total) + 1, total=total)
    z = known.agg(F.max("z")).first()[0] if least is None else least["z"]
    net.threshold = max(LEAST_PROBABILITY, float(1 / (1 + np.exp(-np.clip(z, -40, 40)))) - 1e-9)
    return net


def train(findings: Sequence[tuple[str, int]], recall: float = RECALL, seed: int = 11) -> Network:
    """A calibrated network from labelled windows and generated ones; a quarter is kept aside for calibration."""
    rows = [*findings, *generated(GENERATED, seed)]
    random.Random(seed).shuffle(rows)
    codes, labels = encode([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    cut = len(rows) * 3 // 4
    draw = np.random.default_rng(seed)
    return _calibrate(_learn(_start(draw), codes[:cut], labels[:cut], draw, EPOCHS), codes[cut:], labels[cut:], recall)


def listed(spans: Sequence[tuple[int, int, int]]) -> str:
    """kind:start:end of each span, by start, then kind; joined by commas."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def redact(text: str, spans: Sequence[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    out, at = [], 0
    reach = -1
    for a, b, _ in sorted(spans):
        if a >= reach:
            out += [text[at:a] if at <= a else "", mark]
        reach = max(reach, b)
        at = reach
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """``docs`` with base, spans and redacted: the findings of each whole text.

    ``base`` and ``spans`` list kind:start:end by code points, end exclusive; spans has
    the base findings and those the network adds, of kind ``net``. ``redacted`` is the
    text with all spans replaced by ``[SECRET]``. A null text has no findings and stays null; all other
    columns are kept (the new names get underscores where they are taken). Repeated rows
    get equal results. The network is trained once, on all findings.
    """
    net = train_on(findings(docs), recall)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # fixed size
    names = docs.columns
    text_at = [n.lower() for n in names].index("text")
    new = [free_name(docs, n) for n in ("base", "spans", "redacted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            values = batch.column(text_at).to_pylist()
            bases = [base_spans(t or "") for t in values]
            extra = [(i, a, b) for i, t in enumerate(values) if t for a, b in free_candidates(t, bases[i])]
            sure = shared.value.probabilities(encode([window(values[i], a, b) for i, a, b in extra])) >= shared.value.threshold
            spans = [list(b) for b in bases]
            for (i, a, b), secret in zip(extra, sure.tolist()):
                if secret:
                    spans[i].append((a, b, 3))
            columns = [
                [listed(b) for b in bases],
                [listed(s) for s in spans],
                [redact(t, s) if s else t for t, s in zip(values, spans)],
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.string()) for c in columns)], [*names, *new])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, schema + "".join(f", {n} string" for n in new))
