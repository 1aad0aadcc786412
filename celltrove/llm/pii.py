"""Personal data by candidate gradient boosting.

Base patterns (email, ip, card, phone) always count.  Beyond them, generators of high
recall propose spans, which may overlap: phone numbers without a plus, social security
numbers, addresses spelled out with or without a dot, account numbers (IBAN), IPv6, values
after a word such as password, and key-like tokens by their shape alone.  Boosted trees look
at the format of a candidate and at the words beside it.  Their scores are calibrated for
each kind by isotonic regression, and a candidate of a calibrated probability of at least
LEAST is added.  Added spans that overlap base ones or better ones of their own are dropped.

The trees are trained here on generated candidates (``examples``), positive and negative,
from a fixed seed, and calibrated on a third of them that the trees have not seen; EXAMPLES
bounds their number.  What they find on texts written by hand is tested apart from that.
Spans are code points, end exclusive.  Each scan is linear in the text, also where patterns
nearly match, and reads texts of any length whole.  Row-local: repeated rows have the same
spans; null and empty texts have none.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting
from .common import cuts, table

EXAMPLES, LEAST, SEED = 9000, 0.8, 7
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "ssn", "iban", "ip6")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Starting only where no digit precedes finds the same matches and stays linear.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_LOOSE_PHONE = re.compile(r"(?<![0-9.+-])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}(?![0-9]|[.-][0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9-])")
_DOT = re.compile(r"[ (\[](?:dot|DOT)[ )\]]")
_SPOKEN = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[ (\[](?:at|AT)[ )\]] ?[A-Za-z0-9-]{1,64}(?: ?[ (\[](?:dot|DOT)[ )\]] ?[A-Za-z0-9-]{1,24}){1,4}")
#: A value is judged by its first VALUE characters; an accepted one is a span to its end.
VALUE = 120
_VALUE = re.compile(rf"[\x20\"']{{0,3}}([^\s\"'<>&]{{6,{VALUE}}})")
_MORE = re.compile(r"[A-Za-z0-9_+/=.-]")
_REST = re.compile(r"[^\s\"'<>&]*+")
_ACCESS = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Z])")
#: Tokens without spaces that may be keys; candidates have letters and digits.
_TOKEN = re.compile(rf"(?<![A-Za-z0-9_+/=.-])[A-Za-z0-9_+/=-]{{20,{VALUE}}}(?:\.[A-Za-z0-9_+/=-]{{10,{VALUE}}}){{0,2}}")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:|::?){2,8}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:.])")
# Last parts of spelled addresses.
_ENDS = "com|org|net|edu|gov|io|de|fr|es|it|uk|nl|ch|at|info"
_SPOKEN_END = re.compile(rf"[ (\[](?:{_ENDS})(?![A-Za-z0-9])")
_SPOKEN_LOOSE = re.compile(rf"[A-Za-z0-9._%+-]{{1,64}} ?[ (\[](?:at|AT)[ )\]] ?[A-Za-z0-9-]{{2,64}} (?:{_ENDS})(?![A-Za-z0-9])")
# Words before a candidate that speak for or against personal data.
CUES = (
    ("phone", "tel", "call", "mobile", "fax", "whatsapp", "cell"),
    ("ssn", "social", "security"),
    ("token", "password", "passwd", "pwd", "secret", "key", "apikey", "credential"),
    ("mail", "email", "contact", "write", "reach"),
    ("order", "invoice", "version", "page", "isbn", "date", "year", "item", "id", "total", "serial", "figure", "table", "part", "case", "ticket", "tracking"),
    ("commit", "sha", "md5", "checksum", "hash", "digest", "uuid", "guid", "revision", "blob", "tree", "etag", "build"),
    ("iban", "account", "bank", "transfer", "konto", "bic"),
    ("user", "name", "my", "me", "mine", "bearer", "authorization", "auth", "login", "private", "access", "client"),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def _emails(text: str) -> list[tuple[str, int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append(("email", start, end))
        else:
            end = max(end, at + 1) if start == at else end
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) of the base patterns, by kind and start."""
    out = _emails(text)
    if not _DIGITS.search(text):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m.group())) <= 15]
    return out


def _mixed(said: str) -> bool:
    return any(c.isdigit() for c in said) and any(c.isalpha() for c in said)


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans proposed by the generators; they may overlap each other and the base."""
    out = []
    if _DIGITS.search(text):
        out += [("phone", *m.span()) for m in _LOOSE_PHONE.finditer(text)]
        out += [("ssn", *m.span()) for m in _SSN.finditer(text)]
        out += [("iban", *m.span()) for m in _IBAN.finditer(text) if 15 <= len(m.group().replace(" ", "")) <= 34]
        out += [("secret", *m.span()) for m in _TOKEN.finditer(text) if _mixed(m.group())]
    if "::" in text or text.count(":") > 4:
        out += [("ip6", *m.span()) for m in _IP6.finditer(text) if m.group().count(":") >= 2 and ("::" in m.group() or m.group().count(":") == 7)]
    if "AKIA" in text:
        out += [("secret", *m.span()) for m in _ACCESS.finditer(text)]
    for sign in "=:":
        at = text.find(sign)
        while at >= 0:
            if any(c in text[max(0, at - 24) : at].lower() for c in CUES[2]) and (m := _VALUE.match(text, at + 1)):
                out.append(("secret", *m.span(1)))
            at = text.find(sign, at + 1)
    for anchor, spoken in ((_DOT, _SPOKEN), (_SPOKEN_END, _SPOKEN_LOOSE)):
        done = 0
        for m in anchor.finditer(text):
            if m.start() >= done and (near := spoken.search(text, max(done, m.start() - 140), m.end() + 120)):
                out.append(("email", *near.span()))
                done = near.end()
    return list(dict.fromkeys(out))


def mod97(said: str) -> bool:
    """Whether an account number's check digits hold."""
    plain = said.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def features(text: str, kind: str, start: int, stop: int) -> list[float]:
    said = text[start:stop]
    digits = sum(c in "0123456789" for c in said)
    groups = re.findall(r"[0-9]+", said)
    counts = np.unique(list(said), return_counts=True)[1] / len(said)
    before = re.findall(r"[a-z0-9]+", text[max(0, start - 40) : start].lower())[-4:]
    letters = [c for c in said if c.isalpha()]
    classes = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o" for c in said]
    words = re.findall(r"[A-Za-z]{4,}", said)
    return [
        float(KINDS.index(kind)), len(said), digits, digits / len(said), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        sum(c in " -.()" for c in said), float("(" in said), float("-" in said), float("." in said), float("/" in said), float(" at " in said.lower()), -float(counts @ np.log2(counts)),
        sum(c.isupper() for c in said) / len(said), sum(c in "0123456789abcdefABCDEF" for c in said) / len(said), float(said.startswith("AKIA")), float(sum(c.isalpha() for c in said) > 0 and digits > 0),
        *(float(any(w in cue or w.rstrip("s") in cue for w in before)) for cue in CUES), float(start > 0 and text[start - 1].isalnum()),
        sum(c.lower() in "aeiou" for c in letters) / max(1, len(letters)), sum(a != b for a, b in zip(classes, classes[1:])) / len(said), sum(map(len, words)) / len(said),
        float(kind == "iban" and mod97(said)), float(re.fullmatch(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}", said) is not None), float(said.startswith(("ghp_", "gho_", "sk-", "sk_", "pk_", "xox", "eyJ", "glpat-", "AIza"))),
        float(text[max(0, start - 3) : start].rstrip("\"' ")[-1:] in ("=", ":")), float(text[start - 1 : start] in ("/", "@")),
    ]


def examples(n: int = EXAMPLES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Generated candidates: features, whether personal, kind."""
    rng = random.Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda k=0: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k or rng.randrange(2, 10)))
    pick = lambda *x: rng.choice(x)
    hexa = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    mixed = lambda k: "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789_-") for _ in range(k))
    upper = lambda k: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(k))
    end = lambda: pick("com", "org", "net", "de", "fr", "io", "edu")

    def iban() -> str:
        land, rest = pick("DE", "FR", "GB", "NL", "ES", "IT", "CH"), pick("", upper(4)) + d(rng.choice((14, 16, 18)))
        check = 98 - int("".join(str(int(c, 36)) for c in rest + land + "00")) % 97
        plain = f"{land}{check:02d}{rest}"
        return plain if rng.random() < 0.5 else " ".join(plain[i : i + 4] for i in range(0, len(plain), 4))

    def ip6() -> str:
        full = [hexa(rng.randrange(1, 5)) for _ in range(8)]
        return ":".join(full) if rng.random() < 0.5 else ":".join(full[: rng.randrange(1, 4)]) + "::" + ":".join(full[: rng.randrange(1, 3)])

    key = lambda: pick(hexa(40), hexa(18), hexa(32), hexa(64), mixed(24), mixed(32), mixed(44), "ghp_" + mixed(36), "sk-" + mixed(40), "xoxb-" + d(11) + "-" + mixed(24))
    yes = (
        ("phone", lambda: (pick("call ", "phone ", "tel: ", "mobile ", "fax: ", "call me at ", "my cell is ", "reach me on ", "text "), pick(f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"0{d(3)} {d(6)}", d(10), f"0{d(2)} {d(4)} {d(4)}", f"1-{d(3)}-{d(3)}-{d(4)}"))),
        ("phone", lambda: (word() + " ", f"({d(3)}) {d(3)}-{d(4)}")),
        ("ssn", lambda: (pick("ssn ", "SSN: ", "social security ", "my social security number is ", "social security no. ", "SSN is "), f"{d(3)}-{d(2)}-{d(4)}")),
        ("secret", lambda: (pick("token = ", "password=", "secret: ", "api key = ", "pwd: ", "apikey=", 'token": "', "API_KEY=", "client secret: ", "password is: ", "access_token="), key())),
        ("secret", lambda: (pick("bearer ", "Authorization: Bearer ", "token ", "use key ", "the secret is ", "private key "), key())),
        ("secret", lambda: (word() + " ", pick("ghp_" + mixed(36), "gho_" + mixed(36), "sk-" + mixed(40), "glpat-" + mixed(20), "AIza" + mixed(35), "eyJ" + mixed(30) + "." + mixed(40) + "." + mixed(30), mixed(40), mixed(48)))),
        ("secret", lambda: (pick(word() + " ", word() + ": ", word() + " " + word() + ", "), "AKIA" + pick("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), upper(8) + d(1) + upper(7)))),
        ("email", lambda: (pick("mail ", "contact ", "reach me: ", "write to ", "email "), f"{word()}{pick('.', '')}{word()}{pick(' at ', ' (at) ', ' [at] ')}{word()}{pick(' dot ', ' (dot) ', ' [dot] ')}{end()}")),
        ("email", lambda: (word() + " ", f"{word()}{pick(' (at) ', ' [at] ')}{word()}{pick(' (dot) ', ' [dot] ')}{end()}")),
        ("email", lambda: (pick("mail ", "contact ", "email ", "my email is ", "write to ", "mail me: "), f"{word()}{pick('.', '', '_')}{word()}{pick(' at ', ' (at) ', ' [at] ')}{word()} {pick('com', 'org', 'net', 'edu')}")),
        ("iban", lambda: (pick("iban ", "IBAN: ", "account ", "transfer to ", word() + " "), iban())),
        ("ip6", lambda: (pick("from ", "host ", "address ", "ip ", word() + " "), ip6())),
    )
    no = (
        lambda: (pick("order ", "invoice ", "item ", "serial ", "id ", "total ", "case ", "tracking ", "part ") + pick("", "no. ", "number "), pick(d(7), d(8), d(10), d(12), f"{d(4)}-{d(6)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}-{d(2)}-{d(4)}")),
        lambda: (word() + " ", pick(d(7), d(9), d(11), d(13), d(15))),
        lambda: (pick("on ", "date ", "since ", word() + " "), f"{pick('19', '20')}{d(2)}-{pick('01', '07', '12')}-{pick('03', '15', '28')}"),
        lambda: (pick("version ", "figure ", "table ", word() + " "), pick(f"{d(1)}.{d(2)}.{d(4)}", f"{d(3)} {d(3)} {d(3)}", f"{d(2)}.{d(2)}.{d(2)}.{d(2)}", f"{d(4)} {d(4)}", f"{d(2)} {d(2)} {d(3)}")),
        lambda: (pick("isbn ", "ISBN "), f"{d(3)}-{d(1)}-{d(4)}-{d(4)}-{d(1)}"),
        lambda: (word() + " ", f"{d(3)}-{d(2)}-{d(4)}" if rng.random() < 0.3 else f"{d(4)}-{d(4)}"),
        lambda: (pick("key: ", "the key=", "password: ", "token: ", "secret: "), pick(word(8), word(7) + ",", "required.", "function(" + word() + ")", word(6) + "-" + word(5), "optional", word(9) + "_" + word(6), word(5) + "." + word(6) + "()", "${" + word(7).upper() + "}")),
        lambda: (word() + " ", f"{word()} at {word()} dot {word()}"),
        lambda: (word() + " ", f"{word()} at the dot {word()}"),
        lambda: (pick(word() + " ", "we met ", "look "), f"{word()} at {word()} {pick('com', 'at', 'it', 'info', 'de', 'es')}"),
        lambda: (pick("commit ", "sha1 ", "md5: ", "checksum ", "hash ", "revision ", "blob ", "sha256:", "etag "), pick(hexa(40), hexa(32), hexa(64))),
        lambda: (pick("uuid ", "id ", word() + " "), f"{hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)}"),
        lambda: (word() + " ", pick(f"{word(7)}-{word(6)}-{word(8)}-{d(4)}", f"{word(8)}_{word(9)}_{word(7)}{d(2)}", f"{word(6)}/{word(8)}/{word(9)}/{d(4)}", f"{word(9).title()}{word(8).title()}{word(7).title()}{d(1)}", f"{upper(6)}_{upper(7)}_{upper(8)}_{d(2)}")),
        lambda: (pick("see ", "https://", "http://www."), f"{word(7)}.{word(3)}/{word(6)}-{word(7)}-{d(6)}/{word(8)}"),
        lambda: (word() + " ", pick(f"{d(2)}:{d(2)}:{d(2)}", f"{word(3)}::{word(6)}", f"{hexa(2)}:{hexa(2)}:{hexa(2)}:{hexa(2)}:{hexa(2)}:{hexa(2)}", f"{d(1)}::{d(2)}")),
        lambda: (pick("model ", "part ", word() + " "), f"{upper(2)}{d(2)} {upper(4)} {d(4)} {d(4)}"),
    )
    x, y, kinds = [], [], []
    while len(y) < n:
        good = rng.random() < 0.5
        meant, make = rng.choice(yes) if good else ("", rng.choice(no))
        before, said = make()
        text = f"{word()} {word()}{pick('. ', ' ', ', ')}{before}{said}{pick(' ', '. ', ', ')}{word()} {word()}"
        at = text.index(said)
        for kind, a, b in candidates(text):
            if a < at + len(said) and b > at:
                x.append(features(text, kind, a, b))
                y.append(float(kind == meant and a >= at - 1 and b >= at + len(said) - 1))
                kinds.append(kind)
    return np.array(x), np.array(y), kinds


@functools.lru_cache(maxsize=1)
def train(n: int = EXAMPLES, seed: int = SEED) -> tuple[boosting.Trees, dict[str, boosting.Calibration]]:
    """Trees from two thirds of the examples, and the calibration of each kind from the last third."""
    x, y, kinds = examples(n, seed)
    cut = 2 * len(y) // 3
    trees = boosting.fit(x[:cut], y[:cut], trees=60)
    p, own = trees.probability(x[cut:]), np.array(kinds[cut:])
    return trees, {k: boosting.isotonic(p[own == k], y[cut:][own == k]) for k in KINDS if (own == k).any()}


def added_spans(text: str, base: list[tuple[str, int, int]], trees: boosting.Trees, calibrated: dict[str, boosting.Calibration]) -> list[tuple[str, int, int, float]]:
    """Candidates beyond the base that the trees accept, best first where they overlap, by kind and start."""
    taken = [(a, b) for _, a, b in base]
    free = [c for c in candidates(text) if not any(c[1] < b and a < c[2] for a, b in taken)] if len(taken) < 200 else _free(candidates(text), taken)
    if not free:
        return []
    scores = trees.probability(np.array([features(text, *c) for c in free]))
    p = np.array([calibrated[c[0]](np.array([s]))[0] for c, s in zip(free, scores, strict=True)])
    out: list[tuple[str, int, int, float]] = []
    for (kind, a, b), q in sorted(zip(free, p.tolist(), strict=True), key=lambda z: (-z[1], z[0][1] - z[0][2], z[0][1], KINDS.index(z[0][0]))):
        if q >= LEAST:
            out.append((kind, a, b, q))
    chosen: list[tuple[str, int, int, float]] = []
    used: set[int] = set()
    for c in out:
        if used.isdisjoint(range(c[1], c[2])):
            used.update(range(c[1], c[2]))
            chosen.append(c)
    return sorted(_whole(text, chosen), key=lambda c: (KINDS.index(c[0]), c[1]))


def _whole(text: str, chosen: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Long values carried to their end; spans of ours inside them are dropped, base ones stay."""
    out, end = [], 0
    for kind, a, b, q in sorted(chosen, key=lambda c: c[1]):
        if b <= end:
            continue
        if kind == "secret" and b - a >= VALUE and _MORE.match(text, b):
            b = end = _REST.match(text, b).end()
        out.append((kind, a, b, q))
    return out


def _free(found: list[tuple[str, int, int]], taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    covered = {i for a, b in taken for i in range(a, b)}
    return [c for c in found if covered.isdisjoint(range(c[1], c[2]))]


def find(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """Add ``out``: struct<base, added>, arrays of (kind, start, stop, p); base spans have p 1."""
    trees, calibrated = train()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())])

    @F.arrow_udf("base array<struct<kind: string, start: long, stop: long, p: double>>, added array<struct<kind: string, start: long, stop: long, p: double>>")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = ("kind", "start", "stop", "p")
        for column in columns:
            for start, count in cuts(column):
                rows = []
                for t in column.slice(start, count).to_pylist():
                    base = base_spans(t) if t else []
                    more = added_spans(t, base, trees, calibrated) if t else []
                    rows.append({"base": [dict(zip(names, (*s, 1.0), strict=True)) for s in base], "added": [dict(zip(names, s, strict=True)) for s in more]})
                yield pa.array(rows, pa.struct([("base", pa.list_(span)), ("added", pa.list_(span))]))

    return docs.withColumn(out, run(text))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with each found span replaced by its kind in brackets; overlapping spans are one, named by the first."""
    trees, calibrated = train()

    # Spans are found and replaced in one Python function, so a task has one worker and not two.
    @F.arrow_udf("string")
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            for start, count in cuts(column):
                yield pa.array([_redacted(t, trees, calibrated) if t else t for t in column.slice(start, count).to_pylist()], pa.string())

    return docs.withColumn(text, run(text))


def _redacted(text: str, trees: boosting.Trees, calibrated: dict[str, boosting.Calibration]) -> str:
    base = base_spans(text)
    found = sorted((a, b, kind) for kind, a, b, *_ in (*base, *added_spans(text, base, trees, calibrated)))
    parts, end = [], 0
    for a, b, kind in found:
        if a >= end:
            parts += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*parts, text[end:]])


def _listed(spans: str | Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and added spans of every document."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    order = lambda s: F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
    every = F.sort_array(F.transform(F.concat("pii.base", "pii.added"), lambda s: F.struct(order(s).alias("o"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    count = lambda k: F.size(F.filter("pii.base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, BASE), F.sha2(_listed("pii.base"), 256).alias("base_sha256"), _listed(every).alias("spans"))
