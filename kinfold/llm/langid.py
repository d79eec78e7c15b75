"""Language identification with a bidirectional gated recurrent network over bytes.

The network is small and is trained here: numpy, backpropagation through time, Adam. Every byte of a window
has a state from the left and one from the right; both together give language probabilities at **every position**,
and a text's probabilities pool those of all its positions.

Gates use the hard sigmoid clip(x/4 + 1/2, 0, 1) and states the soft sign x/(1+|x|): without exponentials the whole
text can be read at a few million positions a second and core. Texts are read in windows of ``WINDOW`` bytes, from
the first byte to the last, thousands of windows at once.

The classifier is fitted on a bounded sample (``texts_per_language`` labelled texts of each language, chosen by a hash
of the id, and ``windows_per_text`` windows of each); prediction reads every byte of every text.

One more class stands for text of **no learned language**. It is trained on windows that are made up: bytes and letters drawn at random, letters
of other scripts, and the labelled windows themselves with their letters exchanged one for one or in another order. What is pooled for it is
the column ``foreign``; the prediction is always a learned language. A text is ``known`` if the evidence that it is foreign (that share, less for a
short text, which says little) is at most that of every one of ``HELD_TEXTS`` labelled texts of each language that were kept from the
fit, or at most ``LEAST_BAR``. Fewer than ``LEAST_HELD`` such texts set no bar: then every text with a letter is known.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import with_columns

WINDOW = 64
HIDDEN = 8
#: Windows that are computed together.
BATCH = 1024
PAD = 256
UNDETERMINED = "und"
MOST_LANGUAGES = 1000
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Net:
    """inputs[d]: what a byte adds to the three gates; states[d]: what the state adds; out: position's logits (a column for each language,
    and where made-up windows were learnt one more for them)."""

    languages: list[str]
    inputs: list[np.ndarray]  # per direction (257, 3H): update, reset, candidate
    states: list[np.ndarray]  # per direction (H, 3H)
    out: np.ndarray  # (2H + 1, C)


def _gate(x: np.ndarray) -> np.ndarray:
    return np.clip(0.25 * x + 0.5, 0.0, 1.0)


def _run(net: Net, d: int, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (T, B, H) of direction ``d`` over codes (T, B)."""
    table, u, h_size = net.inputs[d], net.states[d], net.states[d].shape[0]
    steps, width = codes.shape
    h, out = np.zeros((width, h_size), dtype=np.float32), np.empty((steps, width, h_size), dtype=np.float32)
    u_gates, u_cand = np.ascontiguousarray(u[:, :2 * h_size]), np.ascontiguousarray(u[:, 2 * h_size:])
    for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
        x = table[codes[t]]
        gates = h @ u_gates
        gates += x[:, :2 * h_size]
        gates *= 0.25
        gates += 0.5
        np.clip(gates, 0.0, 1.0, out=gates)
        z, r = gates[:, :h_size], gates[:, h_size:]
        c = (r * h) @ u_cand
        c += x[:, 2 * h_size:]
        soft = np.abs(c)
        soft += 1.0
        np.divide(c, soft, out=soft)
        if keep is not None:
            keep.append((t, h, gates, c, soft))
        h = h + z * (soft - h)
        out[t] = h
    return out


def position_logits(net: Net, codes: np.ndarray) -> np.ndarray:
    """(T, B, C)"""
    left, right = _run(net, 0, codes), _run(net, 1, codes)
    n = left.shape[2]
    return left @ net.out[:n] + right @ net.out[n:2 * n] + net.out[2 * n]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _gradients(net: Net, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over all real positions, and its gradients by backpropagation through time."""
    kept: list[list] = [[], []]
    sides = [_run(net, d, codes, kept[d]) for d in (0, 1)]
    n = net.states[0].shape[0]
    p = _softmax(sides[0] @ net.out[:n] + sides[1] @ net.out[n:2 * n] + net.out[2 * n])
    real = codes != PAD
    weight = real / max(1, real.sum())
    loss = float(-(np.log(np.take_along_axis(p, labels[None, :, None], axis=2)[..., 0] + 1e-9) * weight).sum())
    p[:, np.arange(len(labels)), labels] -= 1.0
    delta = (p * weight[..., None]).astype(np.float32)
    flat = delta.reshape(-1, delta.shape[2])
    grads = {"out": np.concatenate([sides[0].reshape(-1, n).T @ flat, sides[1].reshape(-1, n).T @ flat, flat.sum(axis=0, keepdims=True)])}
    for d in (0, 1):
        u = net.states[d]
        from_out = delta @ net.out[d * n:(d + 1) * n].T
        g_table, g_u = np.zeros_like(net.inputs[d]), np.zeros_like(u)
        carried = np.zeros((codes.shape[1], n), dtype=np.float32)
        for t, h, gates, c, soft in reversed(kept[d]):
            dh = from_out[t] + carried
            z, r = gates[:, :n], gates[:, n:]
            open_ = ((gates > 0) & (gates < 1)) * np.float32(0.25)
            dc = dh * z / (1.0 + np.abs(c)) ** 2
            back = dc @ u[:, 2 * n:].T  # to r * h
            da = np.concatenate([dh * (soft - h), back * h], axis=1) * open_
            carried = dh * (1.0 - z) + back * r + da @ u[:, :2 * n].T
            full = np.concatenate([da, dc], axis=1)
            g_u[:, :2 * n] += h.T @ da
            g_u[:, 2 * n:] += (r * h).T @ dc
            np.add.at(g_table, codes[t], full)
        g_table[PAD] = 0.0
        grads[f"inputs{d}"], grads[f"states{d}"] = g_table, g_u
    return loss, grads


#: Letters of scripts from which made-up windows are drawn (first and last code point).
SCRIPTS = ((0x61, 0x7A), (0xC0, 0x17F), (0x391, 0x3C9), (0x410, 0x44F), (0x5D0, 0x5EA), (0x621, 0x64A), (0x905, 0x939), (0xE01, 0xE2E), (0x3041, 0x30FE), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))


#: Made-up windows, at least; labelled texts of each language for the bar of known ones; the lowest and the highest bar.
MADE_UP, HELD_TEXTS, LEAST_BAR, HIGHEST_BAR = 3000, 100, 0.65, 0.99
#: Bytes of text that halve the evidence; texts that set a bar, at least.
SHORT, LEAST_HELD = 16, 20


def made_up(rng: np.random.Generator, window: bytes) -> bytes:
    """About ``WINDOW`` bytes of no language: noise, words of random letters, or a window with its letters exchanged or reordered."""
    kind = int(rng.integers(0, 5))
    if kind == 0:
        return rng.integers(33, 256, WINDOW).astype(np.uint8).tobytes()
    if kind == 1:  # words of a script's letters, a few of which are frequent
        lo, hi = SCRIPTS[int(rng.integers(0, len(SCRIPTS)))]
        letters = rng.integers(lo, hi + 1, 20)
        words = ["".join(chr(int(c)) for c in rng.choice(letters, int(rng.integers(1, 10)))) for _ in range(12)]
        return " ".join(words).encode()[:WINDOW]
    text = window.decode("utf-8", "ignore")
    places = [i for i, c in enumerate(text) if c.isalpha()]
    out = list(text)
    if kind == 2:  # a letter becomes another one, the same wherever it stands
        other = dict(zip("abcdefghijklmnopqrstuvwxyz", rng.permutation(list("abcdefghijklmnopqrstuvwxyz")).tolist(), strict=True))
        out = [other.get(c.lower(), c) for c in text]
    elif kind == 3:  # the letters change places
        for i, j in zip(places, rng.permutation(len(places)).tolist(), strict=True):
            out[i] = text[places[j]]
    else:  # any letters in the places of letters
        for i in places:
            out[i] = chr(int(rng.integers(97, 123)))
    return "".join(out).encode()


def train(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = 400, batch: int = 128, rate: float = 0.02, windows_per_text: int = 4, seed: int = 7,
          reject: bool = False) -> Net:
    """A net fitted to windows of the texts (and, with ``reject``, to as many made-up ones as a language has); the same input gives the same net."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    rows, truth = [], []
    for text, label in zip(texts, labels, strict=True):
        for _ in range(min(windows_per_text, 1 + len(text) // WINDOW)):
            a = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
            size = WINDOW if rng.random() < 0.7 else int(rng.integers(4, WINDOW))  # short texts and last windows too
            piece = np.frombuffer(text[a:a + size], dtype=np.uint8).astype(np.int64)
            rows.append(np.pad(piece, (0, WINDOW - len(piece)), constant_values=PAD))
            truth.append(languages.index(label))
    if reject:
        pieces = [bytes(r[r != PAD].astype(np.uint8)) for r in rows]
        for i in rng.integers(0, len(pieces), max(MADE_UP, len(pieces) // 2)).tolist() if pieces else ():
            piece = np.frombuffer(made_up(rng, pieces[i])[:WINDOW], dtype=np.uint8).astype(np.int64)
            rows.append(np.pad(piece, (0, WINDOW - len(piece)), constant_values=PAD))
            truth.append(len(languages))
    codes, truth_a = np.array(rows, dtype=np.int64).reshape(-1, WINDOW), np.array(truth, dtype=np.int64)

    def start(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) * 0.3).astype(np.float32)

    net = Net(languages, [start(257, 3 * hidden) for _ in (0, 1)], [start(hidden, 3 * hidden) for _ in (0, 1)], start(2 * hidden + 1, len(languages) + reject))
    for table in net.inputs:
        table[PAD] = 0.0
    params = {"out": net.out, **{f"inputs{d}": net.inputs[d] for d in (0, 1)}, **{f"states{d}": net.states[d] for d in (0, 1)}}
    first, second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in (0, 1))
    by_language = [np.flatnonzero(truth_a == i) for i in range(len(languages) + reject)]
    for step in range(1, steps + 1 if len(codes) else 1):
        share = max(1, batch // len(languages))
        pick = np.concatenate([rng.choice(rows_, share if i < len(languages) else batch // 2) for i, rows_ in enumerate(by_language)])
        _, grads = _gradients(net, codes[pick].T, truth_a[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        lr = rate * min(1.0, 2.0 * (1.0 - (step - 1) / steps))
        for k, v in params.items():
            g = grads[k] * np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            v -= (lr * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return net


def text_probabilities(net: Net, texts: list[bytes]) -> np.ndarray:
    """(len(texts), columns of the net): mean of the positions' probabilities over the whole of each text (empty: all zero)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    windows = -(-sizes // WINDOW)
    total = int(windows.sum())
    out = np.zeros((len(texts), net.out.shape[1]))
    if not total:
        return out
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(texts)), windows)
    nth = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    left = sizes[owner] - nth * WINDOW  # bytes from the window's start to the text's end
    at = begin[owner] + nth * WINDOW
    order = np.argsort(np.minimum(left, WINDOW), kind="stable")  # short windows together
    for a in range(0, total, BATCH):
        own = order[a:a + BATCH]
        length = int(min(WINDOW, left[own].max()))
        column = np.arange(length)[:, None]
        real = column < left[own][None, :]
        codes = np.where(real, flat[np.minimum(at[own][None, :] + column, len(flat) - 1)], PAD)
        p = _softmax(position_logits(net, codes)) * real[..., None]
        np.add.at(out, owner[own], p.sum(axis=0))
    return out / np.maximum(sizes, 1)[:, None]


def labelled_sample(df: DataFrame, id_col: str, text_col: str, lang_col: str, texts_per_language: int, text_bytes: int = 4096) -> tuple[list[bytes], list[str]]:
    """At most ``texts_per_language`` texts of each language, the first by a hash of the id; of a long text, a stretch.

    The hash threshold of each language comes from its count, so that what is ranked is a few times the sample.
    """
    rows = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("language"))
    rows = rows.withColumn("h", F.xxhash64("id")).where(F.length("text") > 0)
    counts = rows.groupBy("language").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values: it does not name languages")
    if not counts:
        return [], []
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["language"], 4.0 * texts_per_language / r["n"])])
    near = rows.where(F.col("h") / F.lit(2.0 ** 63) <= share[F.col("language")] - 1.0)
    stretch = F.expr(f"substring(text, cast(1 + pmod(h, greatest(1, length(text) - {text_bytes} + 1)) as int), {text_bytes})")
    ranked = near.select("language", "h", "id", stretch.alias("text")).withColumn("nth", F.row_number().over(Window.partitionBy("language").orderBy("h", "id", "text")))
    got = ranked.where(F.col("nth") <= texts_per_language).select("language", "text").orderBy("language", "h", "id", "text").collect()
    return [r["text"].encode("utf-8", "surrogatepass") for r in got], [r["language"] for r in got]


def evidence(foreign: float, size: int) -> float:
    """How much a text of ``size`` bytes with a foreign share speaks for no learned language."""
    return foreign * size / (size + SHORT)


def known_bar(net: Net, texts: list[bytes]) -> float:
    """The evidence up to which a text counts as one of a learned language."""
    with_letters = [t for t in texts if LETTER.search(t.decode("utf-8", "surrogatepass"))]
    if len(with_letters) < LEAST_HELD:
        return 1.0
    seen = text_probabilities(net, with_letters)[:, -1].tolist()
    return min(HIGHEST_BAR, max([LEAST_BAR, *(evidence(f, len(t)) for f, t in zip(seen, with_letters, strict=True))]))


def split_sample(texts: list[bytes], labels: list[str], held: int) -> tuple[list[int], list[int]]:
    """(places to learn from, places kept from the fit): the last ``held`` texts of each language, but never more than a quarter of them."""
    places: dict[str, list[int]] = {}
    for i, x in enumerate(labels):
        places.setdefault(x, []).append(i)
    cut = {x: len(p) - min(held, len(p) // 4) for x, p in places.items()}
    return [i for x, p in places.items() for i in p[:cut[x]]], [i for x, p in places.items() for i in p[cut[x]:]]


def identify(df: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts_per_language: int = 400, carry: bool = False) -> DataFrame:
    """One row for each row of ``df``: id, lang_pred, score (pooled probability of that language), foreign (that of no learned language), known.

    Learns from ``labelled`` (bounded sample) and predicts from the text alone. NULL texts and texts without a letter
    are ``und`` with score 0 and foreign 1 and are not known, as is everything when nothing is labelled. With ``carry``, the input row comes as the
    struct ``row`` in place of the id. Ids may be NULL or repeat; an empty table gives an empty result. Other columns of
    ``df`` are not looked at.
    """
    texts, labels = labelled_sample(labelled, id_col, text_col, lang_col, texts_per_language + HELD_TEXTS)
    fit, held = split_sample(texts, labels, HELD_TEXTS)
    net = train([texts[i] for i in fit], [labels[i] for i in fit], reject=True) if labels else None
    bar = known_bar(net, [texts[i] for i in held]) if net else 0.0
    shared = df.sparkSession.sparkContext.broadcast(net)

    def compute(texts_: list) -> list[pa.Array]:
        net = shared.value
        names, scores, foreign = [UNDETERMINED] * len(texts_), [0.0] * len(texts_), [1.0] * len(texts_)
        known = [i for i, t in enumerate(texts_) if net and t and LETTER.search(t)]
        if known:
            p = text_probabilities(net, [texts_[i].encode("utf-8", "surrogatepass") for i in known])
            for i, row, best in zip(known, p, p[:, :len(net.languages)].argmax(axis=1), strict=True):
                names[i], scores[i], foreign[i] = net.languages[best], float(min(1.0, row[best])), float(min(1.0, row[-1]))
        known_ = [name != UNDETERMINED and evidence(f, len(t.encode("utf-8", "surrogatepass"))) <= bar for name, f, t in zip(names, foreign, (t or "" for t in texts_), strict=True)]
        return [pa.array(names, type=pa.string()), pa.array(scores, type=pa.float64()), pa.array(foreign, type=pa.float64()), pa.array(known_, type=pa.bool_())]

    return with_columns(df, id_col, text_col, "lang_pred string, score double, foreign double, known boolean", ["lang_pred", "score", "foreign", "known"], lambda: compute, carry)
