"""Personal data by a skip-chain conditional random field.

The nodes are the tokens of a document. Those without a digit or an at sign are O by construction, that is observed, and
enter as what their transition potentials give their neighbours; the others are labelled. Tokens next to each other are
joined by transition potentials; tokens of a document that repeat, or that have the same
shape, are joined by skip potentials, each to the next of its kind, however far apart. Loopy sum-product message
passing over the whole document makes their labels agree, so that a doubtful occurrence follows the clear ones.

The weights are trained here, by maximum pseudo-likelihood, on a seeded set of generated labelled lines (TRAIN_LINES
of them, whatever the corpus); their held-out accuracy is part of the tests.

Defined cases
* A null or empty text, or one without digits and at signs, reports nothing. A null doc_id reports under null.
* Entities are maximal runs of adjacent tokens with one label, without the punctuation around them. Two entities of the
  same label that touch are one, except e-mail and network addresses, where each token is one.
* Texts of any length are read whole; the messages of one document never reach another. Repeated rows report alike.
* Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELS = ["O", "EMAIL", "PHONE", "CARD", "IP", "SSN", "IBAN"]
TRAIN_LINES = 3000
ROUNDS = 10
LIVE = re.compile(r"[0-9@]\S*")
JUNK = "*#$%&|~^"
LEAD, TAIL = "\"'«<([{", "\"'»>)]},.;:!?"

_cues = {"email": 0, "e-mail": 0, "mail": 0, "phone": 1, "tel": 1, "call": 1, "fax": 1, "mobile": 1, "card": 2, "visa": 2, "credit": 2, "ip": 3, "host": 3, "server": 3, "ssn": 4, "social": 4, "iban": 5, "account": 5, "version": 6, "license": 6, "page": 6, "token": 6, "isbn": 6, "order": 6}
_tests = [
    re.compile(p)
    for p in (
        r"[^@\s]+@[^@\s]+\.[A-Za-z]{2,}",
        r"@.*|.*@",
        r"\(\d{2,4}\)",
        r"\+\d{1,3}",
        r"\d{3}[-.]\d{4}",
        r"\+?\d{0,3}[-.(]{0,2}\d{3}[-.)]{0,2}\d{3}[-.]?\d{4}",
        r"\+\d{9,14}",
        r"\d{3}-\d{2}-\d{4}",
        r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}",
        r"\d{4}",
        r"(?:19|20)\d\d",
        r"\d{4}-\d\d-\d\d|\d{1,2}[./]\d{1,2}[./]\d{2,4}",
        r"\d{1,2}:\d\d.*",
        r"[$€£]?\d+(?:[.,]\d+)*[%€£$]?",
        r"\d+(?:\.\d+){1,2}",
        r"v?\d+(?:\.\d+)+[a-z-].*",
        r"\d{13,19}",
        r"\d{4}-\d{4}-\d{4}-\d{1,7}",
        r"\d{17,}",
        r"\d{10,12}",
        r"\d+",
        r"(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]+",
        r".*[A-Za-z].*",
        r".*[=/\\_].*",
        r".*\d{20,}.*",
    )
]
_quad = re.compile(r"\d{1,3}(?:\.\d{1,3}){3}")
N_FEATURES = 1 + len(_tests) + 1 + 1 + 7 + 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def core(token: str) -> tuple[int, int]:
    """Where the token lies within the punctuation around it; brackets that close within the token stay."""
    s, e = 0, len(token)
    if e and token[-1] in JUNK:
        bare = len(token.rstrip(token[-1]))
        if e - bare > 1:
            e = bare
    close = token.rfind(")")
    while s < e and token[s] in LEAD and not (token[s] == "(" and close >= s):
        s += 1
    opened = token.find("(", s)
    while e > s and token[e - 1] in TAIL and not (token[e - 1] == ")" and -1 < opened < e):
        e -= 1
    return s, e


def features(token: str, before: str) -> list[int]:
    """Indices of the features that hold."""
    on = [0]
    on += [1 + i for i, t in enumerate(_tests) if t.fullmatch(token)]
    k = 1 + len(_tests)
    if _quad.fullmatch(token) and all(int(x) < 256 for x in token.split(".")):
        on.append(k)
    digits = re.sub(r"\D", "", token)
    if 13 <= len(digits) <= 19 and _luhn(digits):
        on.append(k + 1)
    cue = _cues.get(before.strip(":=#.,()\"'").lower())
    if cue is not None:
        on.append(k + 2 + cue)
    return on


def shape(token: str) -> str:
    return re.sub(r"[A-Za-z]+", "a", re.sub(r"\d", "0", token))


def graph(text: str) -> tuple[list[tuple[int, int]], list[list[int]], list[tuple[int, int, int]], list[list[int]]]:
    """(token ranges, features, edges, whether a word lies before and after) of a text's tokens to label; edge kinds: 0 next
    to each other, 1 repeated, 2 of the same shape."""
    places, feats, edges, beside = [], [], [], []
    same: dict[str, int] = {}
    alike: dict[str, int] = {}
    end = 0
    for m in LIVE.finditer(text):
        s = m.start()
        if s < end:
            continue
        while s > end and not text[s - 1].isspace():
            s -= 1
        i, token = len(places), text[s : m.end()]
        a, b = core(token)
        word_before = not text[end:s].isspace() and s > end
        if i and word_before:
            beside[-1][1] = 1
        elif i and s - end <= 3:
            edges.append((i - 1, i, 0))
        beside.append([int(word_before), 0])
        end = m.end()
        before = text[max(0, s - 24) : s].split()
        word = token[a:b]
        places.append((s + a, s + b))
        feats.append(features(word, before[-1] if before else ""))
        key = word.lower()
        if key in same:
            edges.append((same[key], i, 1))
        same[key] = i
        if len(word) >= 5:
            key = shape(word)
            if key in alike and alike[key] != edges_last(edges, i):
                edges.append((alike[key], i, 2))
            alike[key] = i
    if beside and text[end:].strip():
        beside[-1][1] = 1
    run: list[int] = []
    for i, (s, e) in enumerate([*places, (-9, -9)]):
        part = e - s in (3, 4, 5, 6) and text[s:e].isdigit()
        if part and run and s - places[run[-1]][1] == 1:
            run.append(i)
            continue
        if len(run) > 2 and 13 <= sum(places[k][1] - places[k][0] for k in run) <= 19:
            for k in run:
                feats[k].append(N_FEATURES - 1)
        run = [i] if part else []
    return places, feats, edges, beside


def edges_last(edges, i: int) -> int:
    """The token that the last edge joins to i by repetition, or -1."""
    return edges[-1][0] if edges and edges[-1][1:] == (i, 1) else -1


def generate(seed: int, lines: int) -> list[tuple[str, list[int]]]:
    """Lines of made-up words and numbers with the label of every live token."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def email():
        return [f"{word()}{rng.choice(['.', '_', '', '-'])}{rng.choice([d(2), word(), ''])}x@{word()}{rng.choice([d(1), '', '.' + word()])}.{rng.choice(['com', 'org', 'net', 'de', 'example.com'])}"]

    def phone():
        k = rng.randint(0, 5)
        return [[f"+{d(1)}", f"({d(3)})", f"{d(3)}-{d(4)}"], [f"({d(3)})", f"{d(3)}-{d(4)}"], [f"{d(3)}-{d(3)}-{d(4)}"], [f"+{d(11)}"], [f"+1-{d(3)}-{d(3)}-{d(4)}"], [f"{d(3)}.{d(3)}.{d(4)}"]][k]

    def card():
        return [[d(16)], [d(4), d(4), d(4), d(4)], [f"{d(4)}-{d(4)}-{d(4)}-{d(4)}"], [d(15)]][rng.randint(0, 3)]

    def ip():
        return [".".join(str(rng.randint(0, 255)) for _ in range(4))]

    makers = {1: email, 2: phone, 3: card, 4: ip, 5: lambda: [f"{d(3)}-{d(2)}-{d(4)}"], 6: lambda: [f"{rng.choice(['DE', 'FR', 'GB', 'ES'])}{d(2)}{d(rng.randint(14, 20))}"]}
    cues = {1: ["email", "mail"], 2: ["phone", "tel", "call"], 3: ["card", "visa"], 4: ["ip", "host"], 5: ["ssn"], 6: ["iban", "account"]}
    nothing = [
        lambda: f"{rng.randint(0, 20)}.{rng.randint(0, 20)}",
        lambda: f"{rng.randint(0, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 30)}",
        lambda: d(rng.randint(1, 9)),
        lambda: str(rng.randint(1900, 2030)),
        lambda: f"20{d(2)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: f"{rng.randint(0, 23)}:{rng.randint(10, 59)}",
        lambda: f"${d(3)}.{d(2)}",
        lambda: f"{d(2)}%",
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([18, 32, 40, 64]))),
        lambda: f"{word()}{d(2)}",
        lambda: f"@{word()}",
        lambda: f"password={d(4)}{word()}",
        lambda: d(rng.randint(20, 30)),
        lambda: f"{rng.randint(300, 999)}.{rng.randint(300, 999)}.{d(3)}.{d(3)}",
        lambda: f"AKIA{d(3)}{word().upper()}{d(4)}",
        lambda: f"{d(3)}.{d(3)}",
    ]
    out = []
    for _ in range(lines):
        parts: list[str] = []
        labels: list[int] = []
        seen: list[tuple[int, list[str]]] = []
        for _ in range(rng.randint(1, 6)):
            parts += [word() for _ in range(rng.randint(1, 4))]
            if rng.random() < 0.45:
                if seen and rng.random() < 0.3:
                    y, tokens = rng.choice(seen)
                else:
                    y = rng.randint(1, 6)
                    tokens = makers[y]()
                    seen.append((y, tokens))
                if rng.random() < 0.3:
                    parts.append(rng.choice(cues[y]))
            else:
                y, tokens = 0, [rng.choice(nothing)()]
            parts += tokens
            parts[-1] += rng.choice(["", "", "", ".", ",", "!"])
            labels += [y] * len(tokens)
        out.append((" ".join([*parts, word()]), labels))
    return out


@lru_cache(maxsize=1)
def train(seed: int = 5, lines: int = TRAIN_LINES, steps: int = 250) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unary weights, transitions, skip weights by kind), by maximum pseudo-likelihood and full-batch Adam."""
    n_labels = len(LABELS)
    rows, cols, ys, edges, sides, base = [], [], [], [], [], 0
    for text, labels in generate(seed, lines):
        places, feats, es, beside = graph(text)
        if len(places) != len(labels):
            continue
        for i, f in enumerate(feats):
            rows += [base + i] * len(f)
            cols += f
        ys += labels
        sides += beside
        edges += [(base + a, base + b, k) for a, b, k in es]
        base += len(places)
    x = np.zeros((base, N_FEATURES), np.float32)
    x[rows, cols] = 1
    y = np.eye(n_labels, dtype=np.float32)[ys]
    edge = np.array(edges, np.int64).reshape(-1, 3)
    chain = edge[edge[:, 2] == 0]
    near = np.zeros((2, base, n_labels), np.float32)
    for kind in (1, 2):
        e = edge[edge[:, 2] == kind]
        np.add.at(near[kind - 1], e[:, 0], y[e[:, 1]])
        np.add.at(near[kind - 1], e[:, 1], y[e[:, 0]])
    left, right = np.zeros((base, n_labels), np.float32), np.zeros((base, n_labels), np.float32)
    left[:, 0], right[:, 0] = np.array(sides, np.float32).T
    left[chain[:, 1]], right[chain[:, 0]] = y[chain[:, 0]], y[chain[:, 1]]
    params = [np.zeros((N_FEATURES, n_labels)), np.zeros((n_labels, n_labels)), np.zeros(2)]
    m, v = [p * 0 for p in params], [p * 0 for p in params]
    for step in range(1, steps + 1):
        u, t, s = params
        score = x @ u + left @ t + right @ t.T + near[0] * s[0] + near[1] * s[1]
        score -= score.max(1, keepdims=True)
        p = np.exp(score)
        p /= p.sum(1, keepdims=True)
        g = (p - y) / base
        grads = [x.T @ g + 1e-4 * u, left.T @ g + (right.T @ g).T + 1e-4 * t, np.array([(near[k] * g).sum() for k in (0, 1)]) + 1e-4 * s]
        for k in range(3):
            m[k] = 0.9 * m[k] + 0.1 * grads[k]
            v[k] = 0.99 * v[k] + 0.01 * grads[k] ** 2
            params[k] = params[k] - 0.15 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return params[0], params[1], np.clip(params[2], 0.0, 4.0)


def infer(unary: np.ndarray, edges: np.ndarray, transitions: np.ndarray, skip: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals by loopy sum-product in log space; edges of (i, j, kind) over all nodes of many documents at once."""
    n_labels = unary.shape[1]
    belief = unary.copy()
    if len(edges):
        i, j, kind = edges.T
        psi = np.stack([transitions, np.eye(n_labels) * skip[0], np.eye(n_labels) * skip[1]])
        forward, back = psi[kind], psi[kind].transpose(0, 2, 1)
        to_j, to_i = np.zeros((len(edges), n_labels)), np.zeros((len(edges), n_labels))
        for _ in range(rounds):
            out = []
            for source, other, table, old in ((i, to_i, forward, to_j), (j, to_j, back, to_i)):
                z = (belief[source] - other)[:, :, None] + table
                top = z.max(1, keepdims=True)
                message = (top + np.log(np.exp(z - top).sum(1, keepdims=True)))[:, 0, :]
                message -= message.max(1, keepdims=True)
                out.append(0.5 * old + 0.5 * message)
            to_j, to_i = out
            belief = unary.copy()
            np.add.at(belief, j, to_j)
            np.add.at(belief, i, to_i)
    belief -= belief.max(1, keepdims=True)
    p = np.exp(belief)
    return p / p.sum(1, keepdims=True)


def potentials(feats: list[list[int]], sides: list[list[int]], u: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The log potential of each label of each token: its features, and the words beside it, which are O."""
    before, after = np.array(sides, np.float64).T
    return np.array([u[f].sum(0) for f in feats]) + before[:, None] * t[0] + after[:, None] * t[:, 0]


def label_texts(texts: list[str | None], model) -> list[list[tuple[int, int, str]]]:
    """(start, end, label) of every entity of each text."""
    u, t, s = model
    places, feats, edges, sides, owner = [], [], [], [], []
    for k, text in enumerate(texts):
        if not text:
            continue
        p, f, e, beside = graph(text)
        sides += beside
        base = len(places)
        places += p
        feats += f
        owner += [k] * len(p)
        edges += [(base + a, base + b, c) for a, b, c in e]
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    if not places:
        return out
    unary = potentials(feats, sides, u, t)
    y = infer(unary, np.array(edges, np.int64).reshape(-1, 3), t, s).argmax(1)
    last, last_owner = None, None
    for k, (a, b), label in zip(owner, places, y.tolist()):
        if not label:
            last = None
            continue
        found, name = out[k], LABELS[label]
        if last == label and last_owner == k and name in ("PHONE", "CARD") and found and a - found[-1][1] <= 2 and texts[k][found[-1][1] : a].strip(" ") == "":
            found[-1] = (found[-1][0], b, name)
        else:
            found.append((a, b, name))
        last, last_owner = label, k
    return out


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, label), start counted in characters from 0, for every entity."""
    kind = dict(docs.dtypes)["doc_id"]
    model = docs.sparkSession.sparkContext.broadcast(train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                found = [(i, *x) for i, xs in enumerate(label_texts(batch.column(1).to_pylist(), model.value)) for x in xs]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([f[0] for f in found], pa.int64())),
                        pa.array([f[1] for f in found], pa.int64()),
                        pa.array([f[2] - f[1] for f in found], pa.int64()),
                        pa.array([f[3] for f in found], pa.string()),
                    ],
                    names=["doc_id", "start", "length", "label"],
                )

    held = docs.select(F.col("doc_id").alias("d"), F.col("text").alias("t")).where(F.col("t").rlike("[0-9@]"))
    return held.mapInArrow(run, f"doc_id {kind}, start long, length long, label string")
