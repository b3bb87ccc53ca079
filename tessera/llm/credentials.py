"""Secret scan: fixed patterns, and guess costs of values in credential contexts.

The value after a credential word is scored by the number of guesses an
attacker needs: the cheapest way to cut it into common words, dates, repeats,
keyboard walks and brute-force characters, found by dynamic programming. A
value whose cheapest cut still costs ``MIN_LOG10_GUESSES`` is a secret.
"""

from __future__ import annotations

import hashlib
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import map_texts

# fixed values: base patterns of the contract
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a run is a match of [0-9a-f]+, so shorter runs fail as a whole
KINDS = ("assign", "access", "hex", "guess")

#: words that announce a credential, wider than the base pattern, and the value;
#: an authorization header may name a scheme before the value
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth(?P<header>orization)?|bearer"""
    r"""|(?:api|access|private|secret|auth|client)[_\x20-]?(?:key|token|secret))["']?\x20*(?::|=>?|\x20is\x20|\x20)\x20*(?P<quote>["']?)"""
    r"""(?(header)(?:(?:bearer|basic|token|api-?key|negotiate|ntlm)[\x20\t]+)?)(?P<value>[^\s"',;<>()]{6,})""", re.I | re.A)
#: a value that is not quoted and follows a blank only must look like a token
TOKEN_LIKE = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])", re.A | re.S)
MIN_LOG10_GUESSES = 8.0

# fixed values: common passwords and parts of them, commonest first
WORDS = (
    "password", "qwerty", "letmein", "dragon", "baseball", "football", "monkey", "abc", "mustang", "shadow", "master",
    "superman", "batman", "trustno", "hello", "welcome", "login", "admin", "princess", "solo", "starwars", "freedom",
    "whatever", "sunshine", "iloveyou", "flower", "hottie", "loveme", "secret", "summer", "winter", "spring", "autumn",
    "internet", "service", "server", "computer", "michael", "jordan", "hunter", "buster", "soccer", "harley", "andrew",
    "tigger", "charlie", "robert", "thomas", "hockey", "ranger", "daniel", "george", "jessica", "pepper", "ginger",
    "joshua", "maggie", "silver", "orange", "purple", "yellow", "cookie", "cheese", "banana", "coffee", "killer",
    "love", "pass", "word", "test", "user", "guest", "root", "temp", "demo", "example", "sample", "default", "changeme",
    "change", "here", "your", "the", "and", "token", "key", "api", "none", "null", "true", "false", "value", "string",
    "public", "private", "access", "account", "system", "data", "base", "database", "mysql", "oracle", "redis", "backup",
    "dev", "prod", "stage", "local", "host", "home", "work", "office", "company", "manager", "support", "web", "site",
    "mail", "email", "phone", "money", "dollar", "angel", "star", "moon", "blue", "red", "green", "black", "white",
    "lucky", "happy", "crazy", "super", "ultra", "mega", "hack", "hacker", "ninja", "magic", "power", "fire", "storm",
)
# fixed values: rows of a keyboard, and usual stand-ins for letters
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("@431!05$7", "aaeiiosst")
DATE = re.compile(r"(?:19|20)[0-9]{2}(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12][0-9]|3[01]))?)?"
                  r"|(?:0[1-9]|[12][0-9]|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)?[0-9]{2}")
DATE_LENGTHS = (4, 6, 7, 8, 9, 10)

_RANK = {w: math.log10(i + 2) for i, w in enumerate(WORDS)}
_LONGEST = max(map(len, WORDS))
_STEP = {(a, b) for row in ROWS for x, y in zip(row, row[1:]) for a, b in ((x, y), (y, x))}
_SPAN = math.log10(2)  # each further span doubles the ways to order the attack
_YEARS = math.log10(120)


def _brute(c: str) -> float:
    """log10 of the characters that a guess of ``c`` has to try."""
    if c.isdigit():
        return 1.0
    if c.islower() or c.isupper():
        return math.log10(26) if c.isascii() else 2.0
    return math.log10(33) if c.isascii() else 2.5


def log10_guesses(value: str) -> float:
    """log10 of the guesses of the cheapest cut of ``value``; 0 for the empty one.

    ``best[i]`` is the least cost of the first ``i`` characters. A repeat or a
    keyboard walk costs its first character and a small charge for each
    further one, so both are carried along as states; words and dates have a
    bounded length. So the time is linear in the length of the value.
    """
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    best = [0.0] + [math.inf] * n
    brute = repeat = walk = math.inf  # cheapest cuts that end inside such a span
    for i in range(1, n + 1):
        c, b = value[i - 1], best[i - 1]
        cost = _brute(c)
        brute = min(brute, b + (_SPAN if i > 1 else 0.0)) + cost
        start = b + (_SPAN if i > 1 else 0.0)
        same = i > 1 and value[i - 2] == c
        near = i > 1 and (low[i - 2], low[i - 1]) in _STEP
        repeat = min(repeat + math.log10(1.3) if same else math.inf, start + cost + 0.3)
        walk = min(walk + math.log10(1.8) if near else math.inf, start + math.log10(47))
        least = min(brute, repeat, walk)
        for k in range(3, min(_LONGEST, i) + 1):
            part = low[i - k:i]
            r = _RANK.get(part)
            if r is None:
                r = _RANK.get(plain[i - k:i])
                if r is None:
                    continue
                r += math.log10(2)
            if value[i - k:i] != part:  # upper case: first letter, all, or any
                r += math.log10(2) if value[i - k:i] in (part.capitalize(), part.upper()) else k * math.log10(2)
            least = min(least, best[i - k] + r + (_SPAN if i > k else 0.0))
        if c.isdigit():
            for k in DATE_LENGTHS:
                if k <= i and DATE.fullmatch(value, i - k, i):
                    days = math.log10(365) if k > 4 else 0.0
                    least = min(least, best[i - k] + _YEARS + days + (_SPAN if i > k else 0.0))
        best[i] = least
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind as listed."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def guess_spans(text: str, least: float = MIN_LOG10_GUESSES) -> list[tuple[int, int, str, float]]:
    """(start, end, "guess", log10 guesses) of credential values that cost
    ``least`` or more to guess."""
    out, m = [], CONTEXT.search(text)
    while m:
        start, value = m.start("value"), m["value"].rstrip(".:!?")
        blank = not m["quote"] and text[start - 1] == " " and not re.search(r"[:=]|\bis\b", text[m.start():start])
        right = len(value) >= 6 and (not blank or TOKEN_LIKE.match(value))
        cost = log10_guesses(value) if right else 0.0
        secret = right and cost >= least
        if secret:
            out.append((start, start + len(value), "guess", cost))
        # what is no secret may be the context of one ("auth passphrase: ..."); it is short or has no such word but at its end
        m = CONTEXT.search(text, m.end() if secret else start)
    return out


def spell(spans: list[tuple]) -> str:
    return ",".join(f"{s[2]}:{s[0]}:{s[1]}" for s in spans)


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans, max_log10_guesses``.

    Reads ``doc_id, text``; other columns are ignored. Null texts count as
    empty; offsets are code points, ends exclusive; repeated rows give repeated
    results; an empty table gives no rows. Spans of all kinds stand by start,
    then kind in the order assign, access, hex, guess.
    """

    def scan(texts: list[str]) -> dict[str, list]:
        base = [base_spans(t) for t in texts]
        more = [guess_spans(t) for t in texts]
        every = [sorted(b + m, key=lambda s: (s[0], KINDS.index(s[2]))) for b, m in zip(base, more)]
        count = lambda kind: [sum(s[2] == kind for s in b) for b in base]
        return {"n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"),
                "n_guess": [len(m) for m in more],
                "base_sha256": [hashlib.sha256(spell(b).encode()).hexdigest() for b in base],
                "spans": [spell(e) for e in every],
                "max_log10_guesses": [max((s[3] for s in m), default=None) for m in more]}

    return map_texts(docs, scan, ["doc_id"], "text",
                     "n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string, max_log10_guesses double")


def redact_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mark``
    (overlapping spans by one mark); null texts stay null."""

    def clean(text: str) -> str:
        out, at = [], 0
        for start, end in merged([(s[0], s[1]) for s in base_spans(text) + guess_spans(text)]):
            out += [text[at:start], mark]
            at = end
        return "".join(out) + text[at:]

    udf = F.pandas_udf(lambda s: s.map(clean, na_action="ignore"), "string")
    return docs.withColumn("text", udf("text"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of spans as disjoint ones, by start."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out
