"""Personal data: exact base patterns, and a character-level bidirectional LSTM with a CRF on top.

The base finds e-mail addresses, IP addresses, card and phone numbers by pattern and check. The
network learns from spans the base has labelled in a sample, also rewritten in other spellings, and
adds spans of such spellings. A span holds a digit, an "@" or its respelling ("[at]", "at ... dot");
windows lie over the text around those, from the words beside an "@" on. Windows overlap by the
longest span wanted; each is decoded by itself, and the spans found in all windows of a text are
reconciled by choosing the disjoint ones of the highest total score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nodeledger.llm.store import hand_back

# The kinds in their order, and their base patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, kind, end

#: Documents the network is trained on at most, hidden units, context of an anchor.
SAMPLE, HIDDEN, CONTEXT = 500, 16, 12
#: Characters of a window and of the overlap of windows: to learn from, and to decode. The longest
#: address is 64 + 1 + 255 characters; the overlap leaves room for its other spellings.
LEARN, WINDOW, LONGEST = (64, 40), 1024, 352
_BRACKETED, _SPOKEN = r"[\[({<]\s*at\s*[\])}>]", r"(?<=\s)at\s+(?=[a-z0-9.-]+(?:\s+dot\s|\s*[\[({<]\s*dot))"
_ANCHOR = re.compile(rf"[0-9@]|{_BRACKETED}|{_SPOKEN}", re.I)
_AT, _DOT = re.compile(rf"\s*{_BRACKETED}\s*|\s+{_SPOKEN}", re.I), re.compile(r"\s*[\[({<]\s*dot\s*[\])}>]\s*|\s+dot\s+", re.I)
_DOT_BEFORE = re.compile(rf"(?:{_DOT.pattern})\Z", re.I)
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_TAGS = 1 + 2 * len(KINDS)
_PAD = 132


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def valid(kind: int, text: str) -> bool:
    """The check of a kind beyond its pattern."""
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p[-4:] or "0") <= 255 for p in text.split("."))
    digits = "".join(re.findall("[0-9]", text))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 10 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind; leftmost and not overlapping within a kind."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, 0, end))
        at = text.find("@", max(at + 1, end))
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if valid(kind, m[0])]
    return sorted(out)


# --- network ------------------------------------------------------------------------------------


def codes(text: str) -> np.ndarray:
    """A number per character: ASCII as it is, then letters, digits, spaces and others as four kinds."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    for i in np.flatnonzero(points > 127):
        c = text[i]
        points[i] = 128 if c.isalpha() else 129 if c.isdigit() else 130 if c.isspace() else 131
    return points


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    """BiLSTM-CRF: input tables and recurrent weights per direction, emissions, transitions."""

    def __init__(self, seed: int = 5) -> None:
        r = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {f"in{d}": r.normal(0, 0.3, (_PAD + 1, 4 * h)) for d in "fb"} | {f"re{d}": r.normal(0, 0.25, (h, 4 * h)) for d in "fb"}
        for d in "fb":
            self.p[f"in{d}"][:, h : 2 * h] += 1.0  # forget gates begin open
        self.p |= {"out": r.normal(0, 0.2, (2 * h, _TAGS)), "bias": np.zeros(_TAGS), "move": np.zeros((_TAGS, _TAGS))}
        self.p = {c: v.astype(np.float32) for c, v in self.p.items()}

    def _lstm(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        n, steps, h = len(x), x.shape[1], HIDDEN
        out, cell, memory, kept = np.zeros((n, steps, h), np.float32), np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), []
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        for t in order:
            z = self.p[f"in{d}"][x[:, t]] + memory @ self.p[f"re{d}"]
            gates, new = _sigmoid(z[:, : 3 * h]), np.tanh(z[:, 3 * h :])
            before, past = cell, memory
            cell = gates[:, h : 2 * h] * before + gates[:, :h] * new
            squashed = np.tanh(cell)
            memory = gates[:, 2 * h :] * squashed
            out[:, t] = memory
            kept.append((t, gates, new, before, past, squashed))
        return out, kept

    def _lstm_back(self, x: np.ndarray, d: str, kept: list, grad: np.ndarray, into: dict) -> None:
        h = HIDDEN
        d_memory, d_cell = np.zeros((len(x), h), np.float32), np.zeros((len(x), h), np.float32)
        g_in, g_re = np.zeros_like(self.p[f"in{d}"]), np.zeros_like(self.p[f"re{d}"])
        for t, gates, new, before, past, squashed in reversed(kept):
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            dm = grad[:, t] + d_memory
            dc = d_cell + dm * o * (1 - squashed**2)
            dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), dm * squashed * o * (1 - o), dc * i * (1 - new**2)], axis=1)
            np.add.at(g_in, x[:, t], dz)
            g_re += past.T @ dz
            d_memory, d_cell = dz @ self.p[f"re{d}"].T, dc * f
        into[f"in{d}"], into[f"re{d}"] = g_in, g_re

    def emissions(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        (a, ka), (b, kb) = self._lstm(x, "f"), self._lstm(x, "b")
        both = np.concatenate([a, b], axis=2)
        return both @ self.p["out"] + self.p["bias"], both, (ka, kb)

    def gradients(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of tag sequences under the CRF, and its gradients."""
        e, both, (ka, kb) = self.emissions(x)
        n, steps, k = e.shape
        move = self.p["move"]
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for t in range(1, steps):
            ahead[:, t] = _logsum(ahead[:, t - 1][:, :, None] + move, 1) + e[:, t]
        for t in range(steps - 2, -1, -1):
            behind[:, t] = _logsum(move + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        z = _logsum(ahead[:, -1], 1)
        d_e = np.exp(ahead + behind - z[:, None, None])
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(steps), tags].sum(axis=1) + move[tags[:, :-1], tags[:, 1:]].sum(axis=1)
        d_e[rows, np.arange(steps), tags] -= 1
        d_move = np.zeros_like(move)
        joint = ahead[:, :-1, :, None] + move + (e[:, 1:] + behind[:, 1:])[:, :, None, :] - z[:, None, None, None]
        d_move += np.exp(joint).sum(axis=(0, 1))
        np.subtract.at(d_move, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        g = {"move": d_move, "out": both.reshape(-1, 2 * HIDDEN).T @ d_e.reshape(-1, k), "bias": d_e.sum(axis=(0, 1))}
        d_both = d_e @ self.p["out"].T
        self._lstm_back(x, "f", ka, d_both[:, :, :HIDDEN], g)
        self._lstm_back(x, "b", kb, d_both[:, :, HIDDEN:], g)
        return float((z - gold).mean()), {c: v / n for c, v in g.items()}

    def train(self, x: np.ndarray, tags: np.ndarray, passes: int = 10, batch: int = 24, rate: float = 0.03, seed: int = 5) -> None:
        """Adam over shuffled batches, its rate falling to a tenth."""
        one, two = ({c: np.zeros_like(v) for c, v in self.p.items()} for _ in range(2))
        r, step, last = np.random.default_rng(seed), 0, passes * -(-len(x) // batch)
        for _ in range(passes):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                step += 1
                _, g = self.gradients(x[order[i : i + batch]], tags[order[i : i + batch]])
                for c, v in g.items():
                    one[c] = 0.9 * one[c] + 0.1 * v
                    two[c] = 0.99 * two[c] + 0.01 * v * v
                    self.p[c] -= (rate * (1 - 0.9 * step / last) / (1 - 0.9**step) * one[c] / (np.sqrt(two[c] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best tags, emissions) of windows, by Viterbi."""
        e = self.emissions(x)[0]
        score, back = e[:, 0], np.zeros(e.shape, np.int8)
        for t in range(1, e.shape[1]):
            through = score[:, :, None] + self.p["move"]
            back[:, t] = through.argmax(axis=1)
            score = through.max(axis=1) + e[:, t]
        tags = np.zeros(e.shape[:2], np.int64)
        tags[:, -1] = score.argmax(axis=1)
        for t in range(e.shape[1] - 1, 0, -1):
            tags[:, t - 1] = np.take_along_axis(back[:, t], tags[:, t][:, None], 1)[:, 0]
        return tags, e


def _beside(text: str, at: int, step: int) -> int:
    """The last character of the word beside the place before or after ``at``, ``LONGEST`` away at most."""
    seen, k = False, at + step
    while 0 <= k < len(text) and abs(k - at) <= LONGEST and not (seen and text[k].isspace()):
        seen = seen or text[k].isalnum()
        k += step
    return k - step


def windows(text: str, width: int = WINDOW, overlap: int = LONGEST) -> list[tuple[int, int]]:
    """Where windows begin and end so that every anchor has its context and the words beside an "@" in one."""
    out: list[tuple[int, int]] = []
    stretches: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        low, high = m.start(), m.end() - 1
        if not text[low].isdigit():
            first, last = low - LONGEST, high + LONGEST
            low, high = _beside(text, low, -1), _beside(text, high, 1)
            while low > first and (dot := _DOT_BEFORE.search(text, max(low - 12, 0), low)):
                low = _beside(text, dot.start(), -1)
            while high < last and (dot := _DOT.match(text, high + 1)):
                high = _beside(text, dot.end() - 1, 1)
        low, high = max(low - CONTEXT, 0), high + CONTEXT
        while stretches and low <= stretches[-1][1]:
            before = stretches.pop()
            low, high = min(low, before[0]), max(high, before[1])
        stretches.append([low, high])
    for low, high in stretches:
        starts = range(low, max(high - overlap, low + 1), width - overlap)
        out += [(s, max(min(s + width, high + 1), s + LEARN[0])) for s in starts]
    return out


def _cut(text: str, places: list[tuple[int, int]], width: int) -> np.ndarray:
    out = np.full((len(places), width), _PAD)
    for k, (a, b) in enumerate(places):
        c = codes(text[a:b])
        out[k, : len(c)] = c
    return out


def _tags(spans: list[Span], start: int, width: int = LEARN[0]) -> np.ndarray:
    """Tags of a window; the part of a cut span that lies in it is tagged as a part."""
    out = np.zeros(width, np.int64)
    for a, kind, b in spans:
        a, b = a - start, b - start
        if b > 0 and a < width:
            out[max(a, 0) : b] = 2 + 2 * kind
            if a >= 0:
                out[a] = 1 + 2 * kind
    return out


def respelled(text: str, spans: list[Span], r: np.random.Generator) -> tuple[str, list[Span]]:
    """The text with its spans in other common spellings."""
    out, at, new, shift = [], 0, [], 0
    for a, kind, b in spans:
        if a < at:
            continue
        s = text[a:b]
        digits = "".join(re.findall("[0-9]", s))
        way = int(r.integers(6 if kind == 0 else 3))
        if kind == 0:
            name, host = s.split("@", 1)
            dots = host.replace(".", " dot ")
            s = (f"{name} @ {host}", f"{name}(@){host}", f"{name}@ {host}", f"{name} [at] {host}", f"{name}(at){host}", f"{name} at {dots}")[way]
        elif kind == 1:
            s = s.replace(".", ("[.]", " . ", "(.)")[way])
        elif kind == 2:
            s = (".", "/", "  ")[way].join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            d = digits[-10:]
            s = (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}")[way]
        out += [text[at:a], s]
        new.append((a + shift, kind, a + shift + len(s)))
        shift += len(s) - (b - a)
        at = b
    return "".join([*out, text[at:]]), new


def train(texts: list[str], most_windows: int = 1000) -> Tagger:
    """A tagger from texts labelled by the base: as they are, and respelled."""
    r = np.random.default_rng(11)
    x, y = [], []
    for text in texts:
        own = base_spans(text)
        for t, spans in ((text, own), respelled(text, own, r)):
            places = windows(t, *LEARN)
            if places:
                x.append(_cut(t, [(s, s + LEARN[0]) for s, _ in places], LEARN[0]))
                y.append(np.stack([_tags(spans, s) for s, _ in places]))
    tagger = Tagger()
    if x:
        x, y = np.concatenate(x), np.concatenate(y)
        order = r.permutation(len(x))[:most_windows]
        tagger.train(x[order], y[order])
    else:  # nothing to learn from: no span beyond the base
        tagger.p["bias"][0] = 20.0
    return tagger


def candidates(text: str, places: list[tuple[int, int]], tags: np.ndarray, e: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, score) of the spans decoded in the windows of a text, without cut ones."""
    out = []
    for (s, end), line, scores in zip(places, tags, e):
        t, width = 0, min(end - s, len(line))
        while t < width:
            if line[t] == 0:
                t += 1
                continue
            a, kind = t, (line[t] - 1) // 2
            t += 1
            while t < width and line[t] == 2 + 2 * kind:
                t += 1
            if (a > 0 or s == 0) and (t < width or s + t >= len(text)) and s + t <= len(text):
                gain = float((scores[np.arange(a, t), line[a:t]] - scores[a:t, 0]).sum())
                out.append((s + a, int(kind), s + t, gain))
    return out


def added_spans(text: str, found: list[tuple[int, int, int, float]], base: list[Span]) -> list[Span]:
    """The disjoint candidates of the highest total score that pass their kind's check and touch no base span."""
    best: dict[Span, float] = {}
    for a, kind, b, score in found:
        while a < b and text[a].isspace():
            a += 1
        while b > a and (text[b - 1].isspace() or text[b - 1] in ".,;:"):
            b -= 1
        piece = text[a:b]
        if not piece or score < 2 * (b - a) or not _ANCHOR.search(piece) or any(a < y and x < b for x, _, y in base):
            continue
        digits = re.findall("[0-9]+", piece)
        plain = _DOT.sub(".", _AT.sub("@", piece))
        right = (
            (piece.count("@") == 1 and "." in piece.split("@")[1] and piece[0] != "@") or ("@" not in piece and bool(_MAIL.fullmatch(plain))),
            len(digits) == 4 and all(len(d) <= 3 and int(d) <= 255 for d in digits),
            valid(2, piece) if kind == 2 else False,
            valid(3, piece) if kind == 3 else False,
        )[kind]
        if right:
            best[a, kind, b] = max(score, best.get((a, kind, b), score))
    ends = sorted(best, key=lambda s: (s[2], s[0], s[1]))
    # best total over the first k candidates by end, and whether the k-th is taken
    total, taken = [0.0], []
    for k, s in enumerate(ends):
        before = sum(1 for o in ends[:k] if o[2] <= s[0])
        with_it = total[before] + best[s]
        taken.append((with_it > total[k], before))
        total.append(max(total[k], with_it))
    out, k = [], len(ends)
    while k:
        take, before = taken[k - 1]
        if take:
            out.append(ends[k - 1])
        k = before if take else k - 1
    return sorted(out)


def find(texts: list[str], tagger: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) if _ANCHOR.search(t) or "+" in t else [] for t in texts]
    found: list[list] = [[] for _ in texts]
    queue = sorted(((i, p) for i, t in enumerate(texts) for p in windows(t)), key=lambda q: q[1][1] - q[1][0])
    k = 0
    while k < len(queue):
        # windows of like width side by side, as many as fill 512 narrow ones
        size = max(1, 512 * LEARN[0] // (queue[k][1][1] - queue[k][1][0]))
        part = queue[k : k + size]
        while len(part) > 1 and part[-1][1][1] - part[-1][1][0] > 1.25 * (part[0][1][1] - part[0][1][0]):
            part = part[: len(part) // 2]
        k += len(part)
        width = part[-1][1][1] - part[-1][1][0]
        tags, e = tagger.decode(np.concatenate([_cut(texts[i], [p], width) for i, p in part]))
        for row, (i, p) in enumerate(part):
            if tags[row].any():
                found[i] += candidates(texts[i], [p], tags[row : row + 1], e[row : row + 1])
    return [(b, sorted(b + added_spans(t, f, b)) if f else b) for t, f, b in zip(texts, found, base)]


# --- Spark --------------------------------------------------------------------------------------


def fit(docs: DataFrame, sample: int = SAMPLE) -> Tagger:
    """A tagger trained on at most ``sample`` documents that look like having spans, those first by a hash of the id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"@|\+[0-9]|[0-9]{4}|[0-9]\.[0-9]+\.[0-9]"))
    ids = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()
    if not ids:
        return train([])
    wanted = docs.sparkSession.createDataFrame([(r["doc_id"],) for r in ids], "doc_id long")
    # ``sample`` ids are broadcast
    texts = rows.join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    return train([r["text"] for r in texts])


_SPANS = "array<struct<kind:string,start:long,end:long>>"


def pii_spans(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """(doc_id, text, base, spans) for every row of ``docs(doc_id, text)``; offsets in code points.

    ``base`` are the base spans, ``spans`` those and the added ones, by start, then kind. Null
    texts are empty and stay null in ``text``. A null doc_id stays null, repeated rows give as many
    rows. Other columns are not read.
    """
    tagger = tagger or fit(docs)

    def rows(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for i in range(0, len(batch), 1000):
                part = batch.slice(i, 1000)
                found = find(pc.fill_null(part.column(1), "").to_pylist(), tagger)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array([rows(f[k]) for f in found], kind) for k in (0, 1))], names=["doc_id", "text", "base", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id long, text string, base {_SPANS}, spans {_SPANS}")


def redacted(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets, e.g. ``[email]``; same columns.

    Overlapping spans are replaced as one, under the kind of the first. Null texts stay null.
    """
    tagger = tagger or fit(docs)
    where = docs.columns.index("text")

    def hide(text: str, spans: list[Span]) -> str:
        out, at = [], 0
        for a, k, b in spans:
            if a >= at:
                out += [text[at:a], f"[{KINDS[k]}]"]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(where).to_pylist()
            found = find([t or "" for t in texts], tagger)
            hidden = [t if t is None else hide(t, s) for t, (_, s) in zip(texts, found)]
            yield batch.set_column(where, batch.schema.field(where), pa.array(hidden, batch.schema.field(where).type))

    return docs.mapInArrow(run, docs.schema)
