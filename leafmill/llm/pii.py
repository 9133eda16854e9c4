r"""Personal data: base patterns, and a character BiLSTM with CRF transitions that adds spans.

Base kinds, leftmost and non-overlapping, failing matches dropped without a retry: ``email``,
``ip`` (parts up to 255), ``card`` (13 to 19 digits passing Luhn), ``phone`` (``+`` and 9 to
15 digits).  Each finder is linear in the text: runs are taken at their start, and an
e-mail is read to both sides of its ``@``.

The tagger is trained in numpy from labelled spans: windows around base spans of each kind,
and around digits and ``@`` that are no span, at most ``WINDOWS_PER_KIND`` of each by a hash
over all documents (a documented bound; nothing else is sampled).  A window is 96
characters, encoded by character class; a forward and a backward LSTM give emissions for
the tags O, B-kind and I-kind, and CRF transitions are learned with them.

Texts are tagged whole.  Every kind needs a digit or ``@``, and a span has one within
``REACH`` characters of each of its own, so where there is none all tags are O without
computing; the rest is cut into windows that overlap by half a window's context, decoded by
Viterbi in one batch, and reconciled: each position takes the tag of the window in which it
is most central, and spans are read from the sequence of the whole text.  A tagged span is
added if it passes its kind's checks and overlaps no base span.

Defined results: null or empty texts have no spans; positions are code points, end
exclusive; repeated rows and ties give equal results; with no labelled span at all nothing
is trained or added; very long texts are tagged in bounded batches; extra columns pass
through; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import table

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]+")
NOT_DIGIT = re.compile(r"[^0-9]+")

WIDTH, EDGE, REACH = 96, 16, 32
WINDOWS_PER_KIND, SALTS = 256, 16
HIDDEN, STEPS, BATCH, RATE = 12, 200, 48, 0.02
BATCH_WINDOWS = 2048
TAGS = 1 + 2 * len(KINDS)  # O, then B and I of each kind

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > last and text[first - 1] in LOCAL:
            first -= 1
        m = DOMAIN.match(text, at + 1) if first < at else None
        if m:
            yield first, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def valid(kind: int, said: str) -> bool:
    """Whether a span of this kind passes the checks of the kind."""
    digits = NOT_DIGIT.sub("", said)
    if kind == 0:
        name, _, host = said.partition("@")
        return bool(name) and "." in host.strip(".")
    if kind == 1:
        return IP.fullmatch(said) is not None and octets(said)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def octets(said: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in said.split("."))


def base_spans(text: str) -> list[Span]:
    """The base spans by kind, then start."""
    spans: list[Span] = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if TRIGGER.search(text):
        spans += [(1, *m.span()) for m in IP.finditer(text) if octets(m[0])]
        spans += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d)]
        if "+" in text:
            spans += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return spans


def class_table() -> np.ndarray:
    """Character classes of the first 128 code points; all others are letters (2)."""
    out = np.zeros(128, np.int8)
    for i in range(128):
        c = chr(i)
        out[i] = 1 if c.isdigit() else 2 if c.islower() else 3 if c.isupper() else 0
    for k, c in enumerate("@.+-() ,:;\n_/'\"=%|", start=4):
        out[ord(c)] = k
    return out


CLASSES, N_CLASSES, PAD = class_table(), 23, 22


def classes_of(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, CLASSES[np.minimum(codes, 127)], 2).astype(np.int8)


class Tagger:
    """Forward and backward LSTM over character classes, linear emissions, CRF transitions."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        f = lambda *shape: rng.normal(0, 0.3, shape)
        self.p = {
            "x": f(2, N_CLASSES, 4 * HIDDEN),
            "h": f(2, HIDDEN, 4 * HIDDEN),
            "b": np.zeros((2, 1, 4 * HIDDEN)),
            "o": f(2 * HIDDEN, TAGS),
            "ob": np.zeros(TAGS),
            "t": np.zeros((TAGS, TAGS)),
        }
        self.p["b"][:, :, HIDDEN : 2 * HIDDEN] = 1.0

    @staticmethod
    def allowed() -> np.ndarray:
        """I of a kind follows B or I of it only."""
        ok = np.ones((TAGS, TAGS), bool)
        for k in range(len(KINDS)):
            ok[:, 2 + 2 * k] = False
            ok[1 + 2 * k : 3 + 2 * k, 2 + 2 * k] = True
        return ok

    def emissions(self, x: np.ndarray, tape: list | None = None) -> np.ndarray:
        """(B, T) classes -> (B, T, TAGS)."""
        n, length = x.shape
        both = np.stack((x, x[:, ::-1]))
        h, c = np.zeros((2, n, HIDDEN)), np.zeros((2, n, HIDDEN))
        states = np.empty((length, 2, n, HIDDEN))
        for t in range(length):
            z = np.stack((self.p["x"][0][both[0, :, t]], self.p["x"][1][both[1, :, t]])) + h @ self.p["h"] + self.p["b"]
            s = 1 / (1 + np.exp(-z[:, :, : 3 * HIDDEN]))
            i, f, o = s[:, :, :HIDDEN], s[:, :, HIDDEN : 2 * HIDDEN], s[:, :, 2 * HIDDEN :]
            g = np.tanh(z[:, :, 3 * HIDDEN :])
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if tape is not None:
                tape.append((h, before, i, f, o, g, tc))
            h = o * tc
            states[t] = h
        out = np.concatenate((states[:, 0], states[::-1, 1]), 2).transpose(1, 0, 2)
        if tape is not None:
            tape.append((both, out))
        return out @ self.p["o"] + self.p["ob"]

    def transitions(self) -> np.ndarray:
        return np.where(self.allowed(), self.p["t"], -1e4)

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood and gradients."""
        tape: list = []
        e = self.emissions(x, tape)
        n, length, _ = e.shape
        trans = self.transitions()
        potential = np.exp(trans)
        top = e.max(2, keepdims=True)
        w = np.exp(e - top)
        a, b, scale = np.empty_like(w), np.empty_like(w), np.empty((n, length))
        for t in range(length):
            now = w[:, t] * (a[:, t - 1] @ potential if t else 1.0)
            scale[:, t] = now.sum(1)
            a[:, t] = now / scale[:, t : t + 1]
        b[:, -1] = 1.0
        grad_t = np.zeros((TAGS, TAGS))
        for t in range(length - 1, 0, -1):
            follow = w[:, t] * b[:, t] / scale[:, t : t + 1]
            grad_t += potential * (a[:, t - 1].T @ follow)
            b[:, t - 1] = follow @ potential.T
        rows = np.arange(n)[:, None]
        steps = np.arange(length)[None]
        gold = e[rows, steps, y].sum() + trans[y[:, :-1], y[:, 1:]].sum()
        loss = (np.log(scale).sum() + top.sum() - gold) / n
        grad_e = a * b
        grad_e /= grad_e.sum(2, keepdims=True)
        grad_e[rows, steps, y] -= 1
        np.add.at(grad_t, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        grads = self.backward(grad_e / n, tape)
        grads["t"] = np.where(self.allowed(), grad_t, 0) / n
        return float(loss), grads

    def backward(self, grad_e: np.ndarray, tape: list) -> dict:
        both, out = tape[-1]
        n, length, _ = grad_e.shape
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["o"] = out.reshape(-1, 2 * HIDDEN).T @ grad_e.reshape(-1, TAGS)
        g["ob"] = grad_e.sum((0, 1))
        into = (grad_e @ self.p["o"].T).transpose(1, 0, 2)
        into = np.stack((into[:, :, :HIDDEN], into[::-1, :, HIDDEN:]), 1)
        dh, dc = np.zeros((2, n, HIDDEN)), np.zeros((2, n, HIDDEN))
        for t in range(length - 1, -1, -1):
            h, before, i, f, o, c, tc = tape[t]
            dh = dh + into[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate((dc * c * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - c * c)), 2)
            g["h"] += h.transpose(0, 2, 1) @ dz
            g["b"] += dz.sum(1, keepdims=True)
            for d in (0, 1):
                np.add.at(g["x"][d], both[d, :, t], dz[d])
            dh = dz @ self.p["h"].transpose(0, 2, 1)
            dc = dc * f
        return g

    def train(self, x: np.ndarray, y: np.ndarray, seed: int = 0) -> list[float]:
        """Adam over random batches; returns the losses."""
        rng, losses = np.random.default_rng(seed), []
        m, v = ({k: np.zeros_like(a) for k, a in self.p.items()} for _ in range(2))
        for k in range(1, STEPS + 1):
            own = rng.integers(0, len(x), min(BATCH, len(x)))
            loss, grads = self.step(x[own], y[own])
            losses.append(loss)
            size = np.sqrt(sum(float((a * a).sum()) for a in grads.values()))
            for name, a in grads.items():
                a = a * min(1.0, 5.0 / max(size, 1e-9))
                m[name] = 0.9 * m[name] + 0.1 * a
                v[name] = 0.99 * v[name] + 0.01 * a * a
                self.p[name] -= RATE * (m[name] / (1 - 0.9**k)) / (np.sqrt(v[name] / (1 - 0.99**k)) + 1e-8)
        return losses

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Viterbi tags of each window."""
        e, trans = self.emissions(x), self.transitions()
        n, length, _ = e.shape
        score, back = e[:, 0] + np.where(np.arange(TAGS) % 2 + (np.arange(TAGS) == 0), 0, -1.0), np.zeros((length, n, TAGS), np.int8)
        for t in range(1, length):
            all_ = score[:, :, None] + trans
            back[t] = all_.argmax(1)
            score = all_.max(1) + e[:, t]
        out = np.empty((n, length), np.int8)
        out[:, -1] = score.argmax(1)
        for t in range(length - 1, 0, -1):
            out[:, t - 1] = back[t][np.arange(n), out[:, t]]
        return out


def regions(text: str) -> list[tuple[int, int]]:
    """The parts of a text within ``REACH`` of a digit or ``@``."""
    out: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def windows(a: int, b: int) -> list[tuple[int, int, int]]:
    """(start of the window, first and last position it decides) for a region."""
    out, at = [], a
    while True:
        own_a = a if at == a else at + EDGE
        last = at + WIDTH >= b
        out.append((at, own_a, b if last else at + WIDTH - EDGE))
        if last:
            return out
        at += WIDTH - 2 * EDGE


def padded(classes: np.ndarray, at: int) -> np.ndarray:
    out = np.full(WIDTH, PAD, np.int8)
    part = classes[at : at + WIDTH]
    out[: len(part)] = part
    return out


def read_tags(tags: np.ndarray, offset: int) -> list[Span]:
    spans, open_ = [], None
    for i, t in enumerate([*tags.tolist(), 0]):
        if open_ and not (t and t % 2 == 0 and (t - 2) // 2 == open_[0]):
            spans.append((open_[0], open_[1] + offset, i + offset))
            open_ = None
        if t % 2 == 1 or (t and not open_):
            open_ = ((t - 1) // 2, i)
    return spans


def tagged_spans(texts: list[str], tagger: Tagger) -> list[list[Span]]:
    """The tagger's spans of each text, windows of all texts in common batches."""
    jobs, tags = [], {}
    for k, text in enumerate(texts):
        for a, b in regions(text):
            tags[k, a] = np.zeros(b - a, np.int8)
            jobs += [(k, a, *w) for w in windows(a, b)]
    held: tuple[int, np.ndarray] = (-1, np.empty(0, np.int8))
    for lo in range(0, len(jobs), BATCH_WINDOWS):
        part, rows = jobs[lo : lo + BATCH_WINDOWS], []
        for k, _, at, _, _ in part:
            if held[0] != k:
                held = (k, classes_of(texts[k]))
            rows.append(padded(held[1], at))
        for (k, a, at, first, last), found in zip(part, tagger.decode(np.array(rows)), strict=True):
            tags[k, a][first - a : last - a] = found[first - at : last - at]
    out: list[list[Span]] = [[] for _ in texts]
    for (k, a), t in tags.items():
        if t.any():
            out[k] += read_tags(t, a)
    return out


def added(text: str, base: list[Span], found: list[Span]) -> list[Span]:
    """Tagged spans that pass their checks and overlap no base span."""
    out = []
    for kind, a, b in found:
        said = text[a:b]
        a += len(said) - len(said := said.lstrip(" \n\t\"'|,:;="))
        said = said.rstrip(" \n\t\"'|,:;=.-")
        b = a + len(said)
        whole = not (said[:1].isdigit() and a and text[a - 1].isdigit()) and not (said[-1:].isdigit() and text[b : b + 1].isdigit())
        if said and whole and valid(kind, said) and all(b <= s or e <= a for _, s, e in base):
            out.append((kind, a, b))
    return out


def training_windows(docs: DataFrame) -> DataFrame:
    """(kind, name, x, y): labelled windows, the ``WINDOWS_PER_KIND`` least hashes of each kind and of none in each of ``SALTS`` parts."""

    def marks_of(text: str, spans: list[Span]) -> Iterator[tuple[int, int, int]]:
        """Kind, hash and start of every span, and of every trigger in none."""
        taken = np.zeros(len(text), bool)
        for _, a, b in spans:
            taken[a:b] = True
        marks = [(k, a) for k, a, _ in spans] + [(len(KINDS), m.start()) for m in TRIGGER.finditer(text) if not taken[m.start()]]
        for kind, a in marks:
            said = f"{a}:{text[a : a + 200]}".encode("utf-8", "surrogatepass")
            yield kind, int.from_bytes(hashlib.blake2b(said, digest_size=8).digest(), "big"), a

    def window(text: str, spans: list[Span], name: int, a: int) -> tuple[bytes, bytes]:
        at = max(0, a - 8 - (name >> 56) % 48)
        y = np.zeros(WIDTH, np.int8)
        for k, s, e in reversed(spans):
            if s < at + WIDTH and e > at:
                y[max(s, at) - at : e - at] = 2 + 2 * k
                if s >= at:
                    y[s - at] = 1 + 2 * k
        return padded(classes_of(text[at : at + WIDTH]), 0).tobytes(), y.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[list] = [[] for _ in range(len(KINDS) + 1)]  # of each kind, the smallest hashes
        for batch in batches:
            for text in batch["text"]:
                if (said := text.as_py()) and TRIGGER.search(said):
                    spans = base_spans(said)
                    for kind, name, a in marks_of(said, spans):
                        own = least[kind]
                        if len(own) < WINDOWS_PER_KIND:
                            heapq.heappush(own, (-name, *window(said, spans, name, a)))
                        elif -name > own[0][0]:
                            heapq.heapreplace(own, (-name, *window(said, spans, name, a)))
        rows = [(k, -e[0], e[1], e[2]) for k, own in enumerate(least) for e in own]
        yield pa.RecordBatch.from_pydict(
            {
                "kind": pa.array([r[0] for r in rows], pa.int32()),
                "name": pa.array([f"{r[1]:016x}" for r in rows], pa.string()),
                "x": pa.array([r[2] for r in rows], pa.binary()),
                "y": pa.array([r[3] for r in rows], pa.binary()),
            }
        )

    found = docs.select("text").mapInArrow(run, "kind int, name string, x binary, y binary")
    found = found.dropDuplicates(["kind", "name"]).withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)))
    rank = F.row_number().over(Window.partitionBy("kind", "salt").orderBy("name", "x", "y"))
    return found.withColumn("rank", rank).where(F.col("rank") <= WINDOWS_PER_KIND).select("kind", "name", "x", "y")


def trained(docs: DataFrame) -> Tagger | None:
    """A tagger from the labelled windows of ``docs`` (a bounded number); None without labelled spans."""
    # at most SALTS * WINDOWS_PER_KIND rows a kind
    every = sorted((r["kind"], r["name"], bytes(r["x"]), bytes(r["y"])) for r in training_windows(docs).collect())
    rows = [r for _, own in groupby(every, itemgetter(0)) for r in islice(own, WINDOWS_PER_KIND)]
    if not any(r[0] < len(KINDS) for r in rows):
        return None
    tagger = Tagger()
    to = lambda i: np.array([np.frombuffer(r[i], np.int8) for r in rows]).astype(np.int64)
    tagger.train(to(2), to(3))
    return tagger


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, spans added) of each text."""
    base = [base_spans(t) for t in texts]
    if tagger is None:
        return [(b, []) for b in base]
    own = [i for i, t in enumerate(texts) if TRIGGER.search(t)]
    more: list[list[Span]] = [[] for _ in texts]
    for i, found in zip(own, tagged_spans([texts[i] for i in own], tagger), strict=True):
        more[i] = added(texts[i], base[i], found)
    return list(zip(base, more, strict=True))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones together) replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` counted again where it was there."""
    model = docs.sparkSession.sparkContext.broadcast(trained(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = all_spans([t or "" for t in texts], model.value)
            new = [t if not (b or m) else redacted(t, b + m) for t, (b, m) in zip(texts, found, strict=True)]
            columns = {n: batch[n] for n in batch.schema.names}
            columns["text"] = pa.array(new, pa.string())
            if "n_chars" in columns:
                old = columns["n_chars"].to_pylist()
                n = [o if a == b else len(b) for o, a, b in zip(old, texts, new, strict=True)]
                columns["n_chars"] = pa.array(n, batch["n_chars"].type)
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, docs.schema)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans of every document, and all its spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = spark.sparkContext.broadcast(trained(docs))
    schema = docs.drop("text").schema
    for k in KINDS:
        schema = schema.add(f"n_{k}", "long")
    schema = schema.add("base_sha256", "string").add("spans", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = all_spans([t or "" for t in batch["text"].to_pylist()], model.value)
            columns = {"doc_id": batch["doc_id"]}
            for k, name in enumerate(KINDS):
                columns[f"n_{name}"] = pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64())
            columns["base_sha256"] = pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in found], pa.string())
            columns["spans"] = pa.array([written(b + m) for b, m in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, schema)
