"""Personal data: fixed patterns, and a character BiLSTM-CRF that adds what they miss.

The patterns find e-mail addresses, IP addresses, payment cards and phone
numbers. The model is a bidirectional LSTM over characters whose emissions go
through a linear-chain CRF; it is trained here, in numpy, on spans that the
patterns label in a bounded sample of windows. Inference cuts the neighbourhood
of every digit and at sign of a text into overlapping windows (no kind of span
is without one), decodes each, and reconciles them over the whole text: where
windows overlap, the one in whose middle a character stands decides.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import arrow_map, sampled, table

KINDS = ("email", "ip", "card", "phone")
#: Characters of a window, the step between windows, and what is looked at on each side of a digit or at sign.
WINDOW, STEP, REACH = 64, 32, 24
#: The model is trained on at most so many windows, of so many digit-bearing documents (those whose ids hash lowest).
TRAIN_DOCS, TRAIN_WINDOWS = 400, 1500
#: The share of documents that hold digits, roughly: TRAIN_DOCS / TRAIN_SHARE documents are looked at.
TRAIN_SHARE = 0.1
#: A span of the model is added when its characters' mean margin over "no span" is this high.
MIN_MARGIN = 0.9

_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-".decode())
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches; each at sign is met once, so a long run of name characters costs no retries."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((begin, m.end()))
            last = m.end()
            at = text.find("@", last)
        else:
            at = text.find("@", at + 1)
    return out


def base_spans(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, by start, then kind as listed."""
    if not text:
        return []
    found = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if _TRIGGER.search(text):
        found += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                d = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(d) <= 19 and luhn(d):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                      if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


# --- the model ---------------------------------------------------------------

#: Characters are grouped: digits, lower and upper case letters, the signs the kinds use one by one, spaces, the rest.
SIGNS = "@._%+-()# :,/'\"\n"
N_CHARS = 4 + len(SIGNS) + 1
#: Labels: none, then begin and inside of each kind.
N_LABELS = 1 + 2 * len(KINDS)


def char_ids(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = np.full(len(c), N_CHARS - 1, np.int64)
    out[(c >= 97) & (c <= 122)] = 1
    out[(c >= 65) & (c <= 90)] = 2
    out[c > 127] = 3
    out[(c >= 48) & (c <= 57)] = 0
    for i, s in enumerate(SIGNS):
        out[c == ord(s)] = 4 + i
    return out


def window_starts(text: str) -> list[int]:
    """Starts of windows that together cover REACH characters on both sides of every digit and at sign."""
    out: list[int] = []
    spans: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if spans and a <= spans[-1][1]:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    for a, b in spans:
        out += range(a, max(a + 1, b - WINDOW + STEP), STEP)
    return out


@dataclass
class Tagger:
    """Weights of both directions (input, recurrent, bias), the output layer and the CRF's transitions."""

    w: dict[str, np.ndarray]

    @staticmethod
    def fresh(hidden: int = 16, seed: int = 3) -> Tagger:
        r = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w[f"x{d}"] = r.normal(0, 0.3, (N_CHARS, 4 * hidden))
            w[f"h{d}"] = r.normal(0, 0.5 / np.sqrt(hidden), (hidden, 4 * hidden))
            w[f"b{d}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        w["o"], w["ob"] = r.normal(0, 0.3, (2 * hidden, N_LABELS)), np.zeros(N_LABELS)
        w["t"] = np.zeros((N_LABELS, N_LABELS))
        return Tagger(w)

    def _lstm(self, d: str, ids: np.ndarray, keep: bool = False):
        h_n = self.w[f"h{d}"].shape[0]
        n, steps = ids.shape
        h, c = np.zeros((n, h_n)), np.zeros((n, h_n))
        hs, tape = np.empty((n, steps, h_n)), []
        x = self.w[f"x{d}"] + self.w[f"b{d}"]
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            z = x[ids[:, t]] + h @ self.w[f"h{d}"]
            i, f, o = (1 / (1 + np.exp(-z[:, k * h_n:(k + 1) * h_n])) for k in range(3))
            g = np.tanh(z[:, 3 * h_n:])
            c_new = f * c + i * g
            tc = np.tanh(c_new)
            if keep:
                tape.append((t, h, c, i, f, o, g, tc))
            h, c = o * tc, c_new
            hs[:, t] = h
        return hs, tape

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        hs = np.concatenate([self._lstm("f", ids)[0], self._lstm("b", ids)[0]], axis=2)
        return hs @ self.w["o"] + self.w["ob"]

    def marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label probabilities by forward-backward, expected transitions, log partition."""
        n, steps, k = e.shape
        t = self.w["t"]
        a, b = np.empty_like(e), np.zeros_like(e)
        a[:, 0] = e[:, 0]
        for s in range(1, steps):
            a[:, s] = e[:, s] + _lse(a[:, s - 1][:, :, None] + t, 1)
        for s in range(steps - 2, -1, -1):
            b[:, s] = _lse(t + (e[:, s + 1] + b[:, s + 1])[:, None, :], 2)
        z = _lse(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None])
        pair = np.zeros((k, k))
        for s in range(1, steps):
            pair += np.exp(a[:, s - 1][:, :, None] + t + (e[:, s] + b[:, s])[:, None, :] - z[:, None, None]).sum(0)
        return p, pair, z

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        n, steps, _ = e.shape
        t = self.w["t"]
        v, back = e[:, 0], np.empty(e.shape, np.int8)
        for s in range(1, steps):
            x = v[:, :, None] + t
            back[:, s] = x.argmax(1)
            v = x.max(1) + e[:, s]
        out = np.empty((n, steps), np.int64)
        out[:, -1] = v.argmax(1)
        for s in range(steps - 1, 0, -1):
            out[:, s - 1] = back[np.arange(n), s, out[:, s]]
        return out

    def gradients(self, ids: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The windows' mean negative log-likelihood and its gradients (back through the CRF and both LSTMs)."""
        n, steps = ids.shape
        f, tf = self._lstm("f", ids, True)
        b, tb = self._lstm("b", ids, True)
        hs = np.concatenate([f, b], axis=2)
        e = hs @ self.w["o"] + self.w["ob"]
        p, pair, z = self.marginals(e)
        rows, cols = np.arange(n)[:, None], np.arange(steps)[None, :]
        gold = e[rows, cols, y].sum(1) + self.w["t"][y[:, :-1], y[:, 1:]].sum(1)
        de = p.copy()
        de[rows, cols, y] -= 1
        de /= n
        g = {"o": hs.reshape(-1, hs.shape[2]).T @ de.reshape(-1, N_LABELS), "ob": de.sum((0, 1))}
        g["t"] = pair / n
        np.add.at(g["t"], (y[:, :-1].ravel(), y[:, 1:].ravel()), -1.0 / n)
        dh = de @ self.w["o"].T
        half = f.shape[2]
        for d, tape, dd in (("f", tf, dh[:, :, :half]), ("b", tb, dh[:, :, half:])):
            gx, gh = np.zeros_like(self.w[f"x{d}"]), np.zeros_like(self.w[f"h{d}"])
            gb = np.zeros_like(self.w[f"b{d}"])
            h_next, c_next = np.zeros((n, half)), np.zeros((n, half))
            for t, h0, c0, i, fg, o, gg, tc in reversed(tape):
                dht = dd[:, t] + h_next
                dc = dht * o * (1 - tc * tc) + c_next
                dz = np.concatenate([dc * gg * i * (1 - i), dc * c0 * fg * (1 - fg), dht * tc * o * (1 - o), dc * i * (1 - gg * gg)], 1)
                np.add.at(gx, ids[:, t], dz)
                gh += h0.T @ dz
                gb += dz.sum(0)
                h_next, c_next = dz @ self.w[f"h{d}"].T, dc * fg
            g |= {f"x{d}": gx, f"h{d}": gh, f"b{d}": gb}
        return float((z - gold).mean()), g


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis=axis))


def labels(text: str, start: int, spans: list[tuple[int, str, int]]) -> np.ndarray:
    """Labels of the window at ``start``; where kinds overlap, the earlier span's."""
    y = np.zeros(WINDOW, np.int64)
    for s, kind, e in reversed(spans):
        k = 1 + 2 * KINDS.index(kind)
        a, b = max(s - start, 0), min(e - start, WINDOW)
        if a < b:
            y[a:b] = k + 1
            if s >= start:
                y[a] = k
    return y


def windows(text: str, starts: list[int]) -> np.ndarray:
    ids = np.concatenate([char_ids(text), np.full(WINDOW, N_CHARS - 1)])
    return ids[np.array(starts)[:, None] + np.arange(WINDOW)[None, :]]


def train_tagger(texts: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.02, seed: int = 3) -> Tagger | None:
    """A tagger from the windows of ``texts`` that the patterns label (Adam); None without a window."""
    xs, ys = [], []
    for text in texts:
        spans = base_spans(text)
        starts = window_starts(text)
        if starts:
            xs.append(windows(text, starts))
            ys += [labels(text, s, spans) for s in starts]
        if len(ys) >= TRAIN_WINDOWS:
            break
    if not ys:
        return None
    x, y = np.concatenate(xs)[:TRAIN_WINDOWS], np.array(ys)[:TRAIN_WINDOWS]
    net, r = Tagger.fresh(seed=seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    v2, step = {k: np.zeros_like(v) for k, v in net.w.items()}, 0
    for _ in range(epochs):
        order = r.permutation(len(y))
        for i in range(0, len(y), batch):
            at = order[i:i + batch]
            _, g = net.gradients(x[at], y[at])
            step += 1
            norm = np.sqrt(sum(float((d * d).sum()) for d in g.values()))
            for k, d in g.items():
                d = d * min(1.0, 5.0 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * d
                v2[k] = 0.999 * v2[k] + 0.001 * d * d
                net.w[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
    return net


def model_spans(net: Tagger, text: str) -> list[tuple[int, str, int]]:
    """Spans of the whole text from its overlapping windows.

    Each character takes its label and its margin from the window whose middle
    is nearest; a span runs from a begin (or first inside) label as far as the
    same kind goes on.
    """
    starts = window_starts(text)
    if not starts:
        return []
    n = len(text)
    nearest = {}
    for lo in range(0, len(starts), 512):
        part = starts[lo:lo + 512]
        e = net.emissions(windows(text, part))
        tags, p = net.viterbi(e), net.marginals(e)[0]
        for i, s in enumerate(part):
            for j in np.flatnonzero(tags[i]).tolist():
                at, off = s + j, abs(2 * j - WINDOW)
                if at < n and (at not in nearest or off < nearest[at][0]):
                    nearest[at] = (off, int(tags[i, j]), 1.0 - float(p[i, j, 0]))
            for j in np.flatnonzero(tags[i] == 0).tolist():
                at, off = s + j, abs(2 * j - WINDOW)
                if at in nearest and off < nearest[at][0]:
                    nearest[at] = (off, 0, 0.0)
    out, run = [], []
    for at in [*sorted(nearest), -1]:
        tag = nearest[at][1] if at >= 0 else 0
        kind = (tag - 1) // 2 if tag else -1
        if run and (at != run[-1][0] + 1 or kind != run[-1][1] or tag % 2 == 1):
            if np.mean([x[2] for x in run]) >= MIN_MARGIN:
                out.append((run[0][0], KINDS[run[0][1]], run[-1][0] + 1))
            run = []
        if tag:
            run.append((at, kind, nearest[at][2]))
    return out


def plausible(text: str, span: tuple[int, str, int]) -> bool:
    """A span of the model must be as long as the shortest of its kind and hold what the kind is made of."""
    s, kind, e = span
    x = text[s:e]
    digits = sum(c.isdigit() for c in x)
    return {"email": "@" in x and len(x) >= 5 and "." in x, "ip": x.count(".") == 3 and 4 <= digits <= 12,
            "card": 13 <= digits <= 19, "phone": 9 <= digits <= 15}[kind]


def all_spans(net: Tagger | None, text: str | None) -> tuple[list, list]:
    """The patterns' spans, and with them those of the model's that overlap none of them."""
    base = base_spans(text)
    if not text or net is None or not _TRIGGER.search(text):
        return base, base
    taken = sorted((s, e) for s, _, e in base)
    extra = [x for x in model_spans(net, text)
             if plausible(text, x) and not any(s < x[2] and x[0] < e for s, e in taken)]
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted([*base, *extra], key=lambda x: (x[0], order[x[1]], x[2]))


def joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)


def train_on(docs: DataFrame) -> Tagger | None:
    """Trained on digit-bearing documents whose ids hash lowest, at most TRAIN_WINDOWS windows of them.

    The tasks send the windows' surroundings, never whole texts.
    """
    def cut_out(b: pa.RecordBatch) -> pa.RecordBatch:
        keys, bits = [], []
        for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            starts = window_starts(x)
            if starts:
                keys.append(k)
                bits.append("\x00".join(x[max(0, s - STEP):s + WINDOW + STEP] for s in starts[:64]))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(bits, pa.string())], ["h", "bits"])
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    src = (sampled(src, TRAIN_DOCS, TRAIN_SHARE).where(F.col("text").rlike("[0-9@]"))
           .select(F.xxhash64("doc_id").alias("h"), "text"))
    rows = sorted(arrow_map(src, cut_out, "h long, bits string").collect(), key=lambda r: (r["h"], r["bits"]))
    return train_tagger([x for r in rows for x in r["bits"].split("\x00")])


def find(docs: DataFrame, net: Tagger | None = None, trained: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (the patterns' spans), base_sha256, spans, n_added for every row.

    Offsets are code points, ends exclusive. A null or empty text has no span
    (the digest is that of the empty string); repeated rows are searched each;
    extra columns are not read. ``net`` is trained on ``docs`` if not ``trained``.
    """
    if net is None and not trained:
        net = train_on(docs)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand weights

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(7)]
        for x in b.column(1).to_pylist():
            base, both = all_spans(shared.value, x)
            for c, k in zip(cols, KINDS, strict=False):
                c.append(sum(s[1] == k for s in base))
            cols[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
            cols[5].append(joined(both))
            cols[6].append(len(both) - len(base))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [b.column(0), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]],
            ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(src, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def mask_text(text: str | None, spans: list[tuple[int, str, int]]) -> str | None:
    """The text with each span's characters replaced by its kind in angle brackets; overlapping spans become one."""
    if not spans:
        return text
    out, at = [], 0
    for s, kind, e in spans:
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, net: Tagger | None = None) -> DataFrame:
    """``docs`` with the text's spans masked; every row and every other column stays as it is."""
    net = net or train_on(docs)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        at = b.schema.get_field_index("text")
        texts = [mask_text(x, all_spans(shared.value, x)[1]) for x in b.column(at).to_pylist()]
        return b.set_column(at, "text", pa.array(texts, b.schema.field(at).type))
    return arrow_map(docs, run, docs.schema)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
