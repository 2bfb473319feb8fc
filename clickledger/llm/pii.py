"""Operator 9: personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans. The field adds what they miss. It looks at groups of neighbouring words that hold a digit, an @,
a word for it, a long unbroken string or what a cue word assigns, cut at white space only. In a group it scores whole
candidate spans by features of the span (numbers of digits, groups, signs, turns between letters and digits, checks,
words for dots, cues before it, what stands at its edges) and finds the best segmentation by dynamic programming over segments of at most
MAX_TOKENS tokens, which chooses boundaries and types together; an entity of more tokens is several segments of one kind on end. Unbroken strings
are one token of any length. Its weights are trained by maximum likelihood on TRAIN_SENTENCES sentences drawn from
a seeded generator: a bounded labelled sample.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone", "secret", "account")
#: Tokens of a segment with a word for @ and of another, digits of a segment of several tokens (no number has more), and sentences of the labelled sample.
MAX_TOKENS = 48
PLAIN_TOKENS = 20
MAX_DIGITS = 34
TRAIN_SENTENCES = 1200

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_NUMBERS = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)+")  # inside a run of digits nothing matches that its start does not
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their @: the local part is the run of its characters before it."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while True:  # the run before @, looked at in widening slices
            low = max(done, a - 256)
            m = _LOCAL_END.search(text, low, a)
            start = m.start() if m else a
            if start > low or low == done:
                break
            a = start
        a = start
        if a < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((a, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def _ips(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _NUMBERS.finditer(text):
        parts, at = m.group().split("."), m.start()
        starts = []
        for p in parts:
            starts.append(at)
            at += len(p) + 1
        for i in range(0, len(parts) - 3, 4):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[i : i + 4]):
                out.append((starts[i], starts[i + 3] + len(parts[i + 3])))
    return out


def _cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if len(m.group()) <= 38:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def _phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15] if "+" in text else []


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    found = (_emails(text), _ips(text), _cards(text), _phones(text))
    return [(k, a, b) for k, spans in enumerate(found) for a, b in spans]


# The field.

#: Spans and words are described by their shape: digits 9, hexadecimal letters f and F, other letters z and Z.
_SHAPE = str.maketrans({chr(c): ("9" if chr(c).isdigit() else "f" if chr(c) in "abcdef" else "F" if chr(c) in "ABCDEF" else "z" if chr(c).islower() else "Z") for c in range(128) if chr(c).isalnum()})
#: A token is a letter and digit run, an unbroken string of at least 24 key characters with a letter, or one other sign.
_TOKEN = re.compile(r"(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{24,}={0,2}|[^\W_]+|[^\w\s]|_")
_WORD = re.compile(r"\S+")
#: What a word must have to be looked at: a digit, @, two colons, twenty signs on end; or to be what a cue assigns.
_SEED = re.compile(r"[0-9@]|\S:\S*:|::|\S{20}")
_ASSIGNED = re.compile(r"(?i)\b(?:passwords?|passwd|passphrase|passcode|pwd|pw|pass|secret|token|credentials?|api[ _-]?key|access[ _-]?key|private[ _-]?key|auth[ _-]?key|kennwort|passwort|mot de passe|contraseña)[\"']?\s*(?::|=|\bis\b|\blautet\b|\best\b|\bes\b)\s*[\"']?(?=\S)")
#: A word between two others of a group: signs only, or up to four capitals (bank codes).
_BETWEEN = re.compile(r"[^\w\s]{1,3}|[A-Z]{1,4}")
_AT = re.compile(r"(?i)\s?[(\[{<]\s?(?:at|ät|@)\s?[)\]}>]\s?|\s(?:at|ät|@)\s(?=\S+?(?:\s(?:dot|punkt)\s|\s?[(\[{<]\s?(?:dot|punkt|\.)\s?[)\]}>]|\.[^\s.]))")
_DOT_RIGHT = re.compile(r"(?i)\s?[(\[{<]\s?(?:dot|punkt|\.)\s?[)\]}>]\s?|\s(?:dot|punkt)\s|\.(?=\w)")
_DOT_LEFT = re.compile(r"(?i)(?:\s?[(\[{<]\s?(?:dot|punkt|\.)\s?[)\]}>]\s?|\s(?:dot|punkt)\s|\.)\Z")
_LABEL = re.compile(r"[^\W_](?:[^\W_]|[-_](?=[^\W_]))*")
_LABEL_END = re.compile(r"[\w+%-]+\Z")

# Cue words by what they announce, endings of addresses, heads of issued keys.
_CUES = {
    "secret": "password passwd passphrase passcode pwd pw pass secret token credential credentials apikey api_key key auth bearer kennwort passwort contraseña",
    "phone": "tel telephone phone call mobile cell fax whatsapp sms ring dial handy telefon rufnummer anruf téléphone teléfono móvil",
    "email": "mail email e-mail write contact reach correo courriel",
    "ip": "ip ipv4 ipv6 server host gateway dns subnet ping",
    "card": "card visa mastercard amex credit debit karte kreditkarte carte tarjeta",
    "account": "iban account konto bank cuenta compte",
    "number": "isbn issn order invoice no nr id version page pages section chapter vol serial item part sku ticket build commit sha sha1 sha256 md5 checksum digest uuid revision population year rechnung artikel",
}
_CUE_OF = {w: k for k, words in _CUES.items() for w in words.split()}
_TLDS = frozenset("com org net edu gov io info biz dev app uk de fr es it eu nl at ch us ca au jp cn in br ru example test".split())
_KEY_HEADS = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "sk-", "sk_live_", "pk_live_", "rk_live_", "xoxb-", "xoxp-", "AIza", "ya29", "eyJ", "hf_", "npm_", "SG.")

_CUE_WORD = re.compile(r"[^\W_]+(?:[_-][^\W_]+)*")


def _cue(text: str, a: int) -> tuple[str, bool]:
    """(what one of the last three words before announces, the nearest first; whether the span is assigned with : or =)."""
    before = re.split(r"[.!?;\n](?:\s|\Z)", text[max(0, a - 48) : a])[-1]
    kind = ""
    for word in reversed(_CUE_WORD.findall(before)[-3:]):
        word = word.lower()
        kind = _CUE_OF.get(word) or next((_CUE_OF[p] for p in reversed(re.split("[-_]", word)) if p in _CUE_OF), "")
        if kind:
            break
    return kind, before.rstrip(" \t\"'(<[")[-1:] in ("=", ":")


def _edge(c: str) -> str:
    return "" if not c or c.isspace() else "a" if c.isalnum() else c if c in "@.-_+/:,%$€£#\"'=!" else "p"


def _octets(s: str) -> bool:
    parts = s.split(".")
    return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)


def mod97(s: str) -> bool:
    """The check of international account numbers."""
    s = re.sub(r"[ -]", "", s)
    if not 15 <= len(s) <= 34 or not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]+", s):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


_CLEAR = re.compile(r"(?i)[(\[{<]\s?(?:at|ät|@|dot|punkt|\.)\s?[)\]}>]|\s(?:dot|punkt)\s")


def _spoken_parts(s: str) -> tuple[int, int, int, bool, bool]:
    """(at signs, dots after the first, gaps without a connector, known ending, a word for a dot or a sign in brackets) of a span with words for @."""
    parts = [x for x in re.split(r"(?i)\s?[(\[{<]\s?(?:at|ät|@)\s?[)\]}>]\s?|(?:^|\s)(?:at|ät|@)(?=\s)", s)]
    ats = len(parts) - 1
    if not ats:
        return 0, 0, 0, False, False
    dot = re.compile(r"(?i)\s?[(\[{<]\s?(?:dot|punkt|\.)\s?[)\]}>]\s?|\s(?:dot|punkt)(?=\s)\s|\.")
    labels = [[y.strip() for y in dot.split(p.strip())] for p in parts]
    gaps = sum(len(y.split()) - 1 if y else 1 for p in labels for y in p)
    return ats, len(labels[1]) - 1, gaps, labels[-1][-1].lower() in _TLDS, bool(_CLEAR.search(s))


FEATURES = (
    "bias", "digits_1_4", "digits_5_6", "digits_7_9", "digits_10_11", "digits_12_15", "digits_16_19", "digits_20", "no_digits", "letters", "one_word", "groups_2", "groups_3_4", "groups_5", "short_group", "even_groups", "plus", "zero", "paren", "dots", "dashes", "spaces", "slashes", "colons_2", "double_colon", "hex_parts", "long_hex_part",
    "checksum", "no_checksum", "account", "hex", "turns_4", "turns_8", "cases_4", "long_20", "long_28", "key_head", "three_parts", "spoken", "spoken_dots", "spoken_gaps", "spoken_ending", "says_at_twice", "date", "amount", "cue_secret", "cue_phone", "cue_email", "cue_ip", "cue_card", "cue_account", "cue_number", "assigned",
    "assigned_secret", "left_a", "left_sign", "right_a", "right_sign", "right_unit", "more_left", "more_right", "odd_edge", "wild", "phone_groups", "cue_phone_7", "secret_word", "dashed_hex", "octets", "spoken_clear", "spoken_unclear", "unbalanced", "bang", "right_bang",
)
_AT_WORD = re.compile(r"(?i)[(\[{<]\s?(?:at|ät|@)\s?[)\]}>]|(?<!\S)(?:at|ät|@)(?!\S)")
_GROUPS = re.compile(r"9+")
_DATE = re.compile(r"(?:99?[./-]99?[./-](?:99)?99|9999[./-]99?[./-]99?)(?:.?[zZT]? ?99?:99(?::99)?)?|99?:99(?::99)?")
_AMOUNT = re.compile(r"9{1,3}(?:[., ]999)+(?:[.,]9+)?|9+[.,]9+")


def _features(shape: str, check: int, zero: bool, octets: bool, account: bool, head: bool, spoken: tuple, cue: str, assigned: bool, left: str, right: str, more_left: bool, more_right: bool) -> np.ndarray:
    """Features of a span, each a property of its signs, of their order, or of what stands beside it."""
    n = shape.count("9")
    groups = [len(g) for g in _GROUPS.findall(shape)]
    letters = any(c in shape for c in "zZfF") or any(c.isalpha() for c in shape)
    words = shape.split()
    parts = shape.split(":")
    turns = sum((a == "9") != (b == "9") for a, b in zip(shape, shape[1:], strict=False) if a.isalnum() and b.isalnum())
    cases = sum(a.islower() != b.islower() for a, b in zip(shape, shape[1:], strict=False) if a.isalpha() and b.isalpha())
    hexed = all(c in "9fF" for c in shape)
    numeric = not letters
    plain = bool(words) and len(words) == 1
    wild = sum(not (c.isalnum() or c.isspace()) for c in shape)
    v = (
        1, 1 <= n <= 4, 5 <= n <= 6, 7 <= n <= 9, 10 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, n >= 20, n == 0, letters, plain, numeric and len(groups) == 2, numeric and 3 <= len(groups) <= 4, numeric and len(groups) >= 5,
        numeric and len(groups) > 1 and min(groups) == 1, numeric and len(groups) > 2 and len(set(groups[:-1])) == 1 and groups[-1] <= groups[0], shape[0] == "+", zero, "(" in shape and ")" in shape, "." in shape, "-" in shape, " " in shape, "/" in shape,
        len(parts) >= 3, "::" in shape, len(parts) >= 3 and all(len(p) <= 4 and all(c in "9fF" for c in p) for p in parts), len(parts) >= 3 and max(map(len, parts)) > 4, check > 0, check < 0, account, hexed and len(shape) >= 24 and letters,
        plain and turns >= 4, plain and turns >= 8, plain and cases >= 4, plain and len(shape) >= 20 and letters, plain and len(shape) >= 28 and letters, head, plain and shape.count(".") == 2 and len(shape) >= 30, spoken[0] == 1, spoken[0] == 1 and spoken[1] >= 1, spoken[2] > 0, spoken[3], spoken[0] > 1,
        bool(_DATE.fullmatch(shape)), bool(_AMOUNT.fullmatch(shape)), cue == "secret", cue == "phone", cue == "email", cue == "ip", cue == "card", cue == "account", cue == "number", assigned, assigned and cue == "secret",
        left == "a", left not in ("", "a", "p", "=", '"', "'", ":"), right == "a", right not in ("", "a", "p", ".", ",", '"', "'", ":", "!"), right in ("%", "$", "€", "£"), more_left, more_right, not (shape[0].isalnum() or shape[0] in "+(:") or not (shape[-1].isalnum() or shape[-1] in "=:)!"), wild > max(4, len(shape) // 3) and not letters,
        numeric and groups in ([3, 3, 4], [1, 3, 3, 4], [2, 3, 4, 4], [3, 4, 4], [3, 4]), cue == "phone" and 7 <= n <= 15 and numeric, plain and assigned and cue == "secret" and letters, bool(re.fullmatch(r"[9fF]{8}(?:-[9fF]{4}){3}-[9fF]{12}", shape)), octets, spoken[0] == 1 and spoken[4], spoken[0] == 1 and not spoken[4], shape.count("(") != shape.count(")"), shape[-1] == "!", right == "!",
    )
    return np.array(v, float)


class Field:
    """Scores spans with weights (kinds by features); a span's features depend on its shape and a few facts, so scores are remembered by these."""

    def __init__(self, w: np.ndarray):
        self.w, self.known = w, {}

    def score(self, key: tuple) -> tuple[int, float]:
        """(best kind, its score)."""
        found = self.known.get(key)
        if found is None:
            if len(self.known) > 100_000:
                self.known.clear()
            s = self.w @ _features(*key)
            found = self.known[key] = (int(s.argmax()), float(s.max()))
        return found


def _spoken(text: str) -> Iterator[tuple[int, int]]:
    """Stretches with a word for @: the labels before it and after it that words for a dot join, however many."""
    for m in _AT.finditer(text):
        a, b = m.start(), m.end()
        while (x := _LABEL_END.search(text, max(0, a - 256), a)) is not None:
            a = x.start()
            if a and x.start() == max(0, x.end() - 256):
                continue
            d = _DOT_LEFT.search(text, max(0, a - 12), a)
            if d is None or not _LABEL_END.search(text, max(0, d.start() - 1), d.start()):
                break
            a = d.start()
        while (x := _LABEL.match(text, b)) is not None:
            b = x.end()
            d = _DOT_RIGHT.match(text, b)
            if d is None or not _LABEL.match(text, d.end()):
                break
            b = d.end()
        if a < m.start() and b > m.end():
            yield a, b


def windows(text: str) -> list[tuple[int, int]]:
    """Groups of neighbouring words that can hold an entity, in order and apart. They end at white space or at the text's ends, a spoken address where its last label ends; no entity spans two."""
    found: list[tuple[int, int]] = []
    at, n = 0, len(text)
    while (m := _SEED.search(text, at)) is not None:
        a, b = m.start(), m.end()
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        while b < n and not text[b].isspace():
            b += 1
        found.append((a, b))
        at = b
    done = 0
    for m in _ASSIGNED.finditer(text):
        if m.end() >= done:
            a = done = m.end()
            while a > 0 and not text[a - 1].isspace():
                a -= 1
            while done < n and not text[done].isspace():
                done += 1
            found.append((a, done))
    found += _spoken(text)
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out:
            p, q = out[-1]
            gap = text[q:a] if a - q <= 12 else None
            if a <= q or (gap is not None and gap.count("\n") < 2 and all(_BETWEEN.fullmatch(w) for w in gap.split())):
                out[-1] = (p, max(b, q))
                continue
        out.append((a, b))
    return out


def _left(text: str, x: int) -> tuple[str, bool, bool]:
    """Of a start: its edge, whether digits go on before it, whether a part with a colon does."""
    left = text[max(0, x - 1) : x]
    digits = x > 1 and (left.isspace() or left in "-./()") and text[x - 2].isdigit() and text[x] in "0123456789("
    return _edge(left), bool(digits), x > 1 and left == ":" and text[x - 2].isalnum()


def _right(text: str, q: int) -> tuple[str, bool, bool]:
    """Of an end: its edge, whether digits go on after it, whether a part with a sign does."""
    return _edge(text[q : q + 1]), bool(text[q - 1].isdigit() and _MORE_DIGITS.match(text, q)), bool(_MORE_PARTS.match(text, q))


_MORE_DIGITS = re.compile(r"[ ./()-]{1,2}[0-9]")
_MORE_PARTS = re.compile(r"[.@:_-]\w")
_NOTHING_SPOKEN = (0, 0, 0, False, False)


def lattice(text: str, a: int, b: int, blocked: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int, tuple]]]:
    """The tokens of a window and its candidate segments (first token, token after the last, key of the features).

    A segment has at most MAX_TOKENS tokens if a word for @ is in it, else at most PLAIN_TOKENS, and at most MAX_DIGITS digits in several tokens; its
    edges are where a word or a sign ends; it has no more than one word for @, no line end and nothing of a base span.
    """
    tokens = [m.span() for m in _TOKEN.finditer(text, a, b)]
    shapes = text[a:b].translate(_SHAPE)
    taken = [False] * len(tokens)
    at = 0
    for p, q in blocked:  # both are in order
        while at < len(tokens) and tokens[at][1] <= p:
            at += 1
        while at < len(tokens) and tokens[at][0] < q:
            taken[at] = True
            at += 1
    digits = [shapes.count("9", p - a, q - a) for p, q in tokens]
    letters = [text[p].isalnum() and d < q - p for (p, q), d in zip(tokens, digits, strict=True)]
    at_words = [m.start() for m in _AT_WORD.finditer(text, a, b)]
    rights: dict[int, tuple] = {}
    out = []
    for i, (x, _) in enumerate(tokens):
        c = text[x]
        if taken[i] or not (c.isalnum() or c in "+(:") or (x and text[x - 1].isalnum() and c.isalnum()):
            continue
        cue = _cue(text, x)
        left, more_digits, more_colon = _left(text, x)
        wanted = cue == ("secret", True)
        n, worded, colons, spaced = 0, False, 0, False
        first_at = bisect_left(at_words, x)
        for j in range(i, min(len(tokens), i + (MAX_TOKENS if at_words else PLAIN_TOKENS))):
            if taken[j]:
                break
            p, q = tokens[j]
            n, worded, colons = n + digits[j], worded or letters[j], colons + (text[p] == ":")
            ats = bisect_left(at_words, q, first_at) - first_at
            if ats > 1 or (not ats and j - i >= PLAIN_TOKENS):
                break
            if j > i:
                gap = text[tokens[j - 1][1] : p]
                spaced = spaced or gap != ""
                if "\n" in gap or n > MAX_DIGITS:
                    break
            e = text[q - 1]
            if not (e.isalnum() or e in "=):" or (e == "!" and text[q - 2].isalnum())) or (q < len(text) and (text[q].isalnum() and e.isalnum() or text[q] == e == "!")):
                continue
            if not ats and ((spaced and not n) or not (n or q - x >= 20 or colons >= 2 or wanted)):
                continue
            shape = shapes[x - a : min(q - a, x - a + 96)]  # of a longer one the beginning tells
            numeric = n > 0 and not worded
            s = text[x:q] if numeric or ats or shape[2:4] == "99" or q - x >= 16 else ""
            if q not in rights:
                rights[q] = _right(text, q)
            right, after_digits, after_parts = rights[q]
            spoken = _spoken_parts(s) if ats else _NOTHING_SPOKEN
            before = (more_digits and c in "0123456789(") or (more_colon and colons > 0) or (ats > 0 and _DOT_LEFT.search(text, max(0, x - 8), x) is not None)
            after = after_digits or after_parts or (ats > 0 and _DOT_RIGHT.match(text, q) is not None)
            check = (1 if luhn(re.sub("[^0-9]", "", s)) else -1) if numeric and 13 <= n <= 19 else 0
            zero = numeric and (c == "0" or (c == "(" and text[x + 1] == "0"))
            octets = numeric and n <= 12 and shape.count(".") == 3 and _octets(s)
            account = s != "" and shape[2:4] == "99" and shape[0] in "ZF" and shape[1:2] in ("Z", "F") and mod97(s)
            out.append((i, j + 1, (shape, check, zero, octets, account, s.startswith(_KEY_HEADS) and len(s) >= 16, spoken, *cue, left, right, before, after)))
    return tokens, out


def best_path(n: int, segments: list[tuple[int, int, float]]) -> list[int]:
    """The indices of the segments (first, after the last, score) of the best segmentation of n tokens, where a token outside of segments scores 0; the first of equal ones."""
    by_end: dict[int, list[int]] = {}
    for x, (_, j, s) in enumerate(segments):
        if s > 0:
            by_end.setdefault(j, []).append(x)
    best, back = [0.0] * (n + 1), [-1] * (n + 1)
    for t in range(1, n + 1):
        best[t] = best[t - 1]
        for x in by_end.get(t, ()):
            v = best[segments[x][0]] + segments[x][2]
            if v > best[t]:
                best[t], back[t] = v, x
    out, t = [], n
    while t:
        if back[t] < 0:
            t -= 1
        else:
            out.append(back[t])
            t = segments[back[t]][0]
    return out[::-1]


def decode(text: str, field: Field, base: list[tuple[int, int, int]] = ()) -> list[tuple[int, int, int]]:
    """The entities of the best segmentation of each window, base spans left out, as (kind number, start, end)."""
    out = []
    blocked, at = sorted((p, q) for _, p, q in base), 0
    for a, b in windows(text):
        while at < len(blocked) and blocked[at][1] <= a:
            at += 1
        mine = blocked[at : bisect_left(blocked, (b, b), at)]
        tokens, cands = lattice(text, a, b, mine)
        if not cands:
            continue
        scored = [field.score(c[2]) for c in cands]
        full = False  # the segment before has as many tokens as one may have
        for x in best_path(len(tokens), [(c[0], c[1], s) for c, (_, s) in zip(cands, scored, strict=True)]):
            i, j, _ = cands[x]
            k, p, q = scored[x][0], tokens[i][0], tokens[j - 1][1]
            if full and out and out[-1][0] == k and tokens[i - 1][1] == out[-1][2] and i > 0:
                out[-1] = (k, out[-1][1], q)  # an entity longer than a segment
            else:
                out.append((k, p, q))
            full = j - i >= PLAIN_TOKENS
    return out


def _sentences(count: int, seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """The labelled sample: text and (start, end, kind) of its entities."""
    r = random.Random(seed)
    syllables = "an er on the ou tion re ly da mo ki sta ver ne qui la os ein sch".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    first = lambda n: r.choice("123456789") + num(n - 1)
    of = lambda signs, n: "".join(r.choice(signs) for _ in range(n))
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def checked(n: int, ok: bool) -> str:
        while luhn(d := first(n)) != ok:
            pass
        return d

    def card() -> str:
        n = r.choice((16, 16, 16, 15, 14, 19))
        d, s = checked(n, True), r.choice(("", " ", "-", ""))
        return s.join((d[:4], d[4:10], d[10:])) if n in (14, 15) else s.join(d[i : i + 4] for i in range(0, n, 4))

    def account() -> str:
        country, tail = of(upper, 2), of("0123456789", r.randint(11, 18)) if r.random() < 0.7 else of(upper, 4) + num(14)
        n = int("".join(str(int(c, 36)) for c in tail + country + "00")) % 97
        whole = f"{country}{98 - n:02d}{tail}"
        return " ".join(whole[i : i + 4] for i in range(0, len(whole), 4)) if r.random() < 0.5 else whole

    dots = lambda: r.choice((" dot ", " dot ", " [dot] ", "(dot)", " (dot) ", " DOT "))
    ats = lambda: r.choice((" at ", " at ", "(at)", " (at) ", " [at] ", " AT ", "[at]"))
    ending = lambda: r.choice(("com", "org", "net", "de", "io", "co", "edu"))
    label = lambda: word() + (num(r.randint(1, 3)) if r.random() < 0.3 else "")
    host = lambda: ".".join([word() for _ in range(r.randint(1, 2))] + [ending()])

    def spoken() -> str:
        d = dots()
        local = d.join(label() for _ in range(r.randint(1, 3)))
        plain = r.random() < 0.25 and "." not in d
        a = ats()
        if plain and a.strip().lower() == "at":
            a = " (at) "
        return local + a + (host() if plain else d.join([label() for _ in range(r.randint(1, 3))] + [ending()]))

    def address() -> str:
        groups = [f"{r.getrandbits(16):x}" for _ in range(8)]
        k = r.random()
        if k < 0.35:
            return ":".join(groups)
        left, right = groups[: r.randint(1, 4)], groups[4 : r.randint(4, 7)]
        return ":".join(left) + "::" + ":".join(right)

    def phone() -> tuple[str, str]:
        s = r.choice((" ", "-", ".", " "))
        k = r.randrange(8)
        if k == 0:
            return "", f"({num(3)}) {num(3)}-{num(4)}"
        if k == 1:
            return "", f"{first(3)}{r.choice('-.')}{num(3)}{r.choice('-.')}{num(4)}"
        if k == 2:
            return "", f"+{first(2)} {num(r.randint(2, 4))} {num(r.randint(3, 4))} {num(r.randint(3, 4))}"
        if k == 3:
            return r.choice(("tel ", "tel. ", "call ", "phone: ", "mobile ", "call us on ", "fax ")), f"0{num(r.randint(2, 4))}{r.choice(' /-')}{num(r.randint(5, 8))}"
        if k == 4:
            return r.choice(("", "", "tel: ")), f"0{num(r.randint(2, 4))} {num(3)} {num(r.randint(3, 4))}"
        if k == 5:
            return r.choice(("tel ", "telephone ", "phone ", "call ", "whatsapp: ", "cell: ")), r.choice((first(10), first(7), f"{first(3)} {num(4)}", f"{first(3)}-{num(4)}"))
        if k == 6:
            return "", f"(0{num(r.randint(2, 3))}) {num(r.randint(6, 8))}"
        return "", f"00{first(2)} {num(3)}{s}{num(3)}{s}{num(r.randint(2, 4))}"

    def secret() -> tuple[str, str]:
        k = r.randrange(9)
        cue = r.choice(('token = "', "secret: ", "password is ", 'api_key = "', "access key ", "token=", "auth_token: "))
        mixed = lambda n: of(lower + upper + "0123456789", n - 2) + num(1) + of(upper, 1)
        if k == 0:
            return cue, of("0123456789abcdef", r.choice((32, 40, 64)))
        if k == 1:
            return r.choice((cue, "", "")), mixed(r.randint(24, 44))
        if k == 2:
            return r.choice((cue, "")), r.choice(("AKIA", "ASIA")) + of(upper + "234567", 16)
        if k == 3:
            return r.choice((cue, "")), r.choice(("ghp_", "gho_", "glpat-", "sk-", "sk_live_", "hf_", "npm_")) + mixed(r.randint(24, 40))
        if k == 4:
            return r.choice((cue, "bearer ", "")), "eyJ" + mixed(r.randint(14, 30)) + "." + "eyJ" + mixed(r.randint(20, 60)) + "." + mixed(r.randint(20, 43))
        if k in (5, 6):
            return r.choice(("password: ", "pw: ", "pwd=", "passwd = ", "pass: ", "password is ", 'password: "')), r.choice((word() + num(r.randint(1, 4)), word().title() + num(4) + "!", of(lower + upper + "0123456789", r.randint(6, 14)) + num(1), word() + word()))
        if k == 7:
            return r.choice((cue, "")), r.choice(("xoxb-", "xoxp-")) + "-".join((num(11), num(12), mixed(24)))
        return cue, mixed(r.randint(20, 40)) + r.choice(("", "=", "=="))

    with_cue = (
        lambda: (r.choice(("", "", "mail ", "write to ", "(")), spoken() if r.random() < 0.85 else f"{word()}.{num(2)}@mail{num(1)}.{host()}"),
        lambda: (r.choice(("", "host ", "from ")), ".".join(str(r.randint(0, 255)) for _ in range(4)) if r.random() < 0.3 else address()),
        lambda: (r.choice(("", "card ", "visa: ")), card()),
        phone,
        secret,
        lambda: (r.choice(("", "iban ", "IBAN: ", "account ")), account()),
    )
    year = lambda: str(r.randint(1900, 2060))
    decoys = (
        lambda: checked(16, False), lambda: checked(r.choice((15, 17, 19)), False), lambda: first(r.randint(5, 15)), lambda: num(r.randint(20, 30)), lambda: f"{year()}-{r.randint(10, 12)}-{num(2)} {num(2)}:{num(2)}:{num(2)}", lambda: f"{num(1)}.{num(2)}.{num(3)}.{num(4)}.{num(2)}",
        lambda: of("0123456789abcdef", r.randint(8, 20)), lambda: "".join(word() for _ in range(9)), lambda: f"{word()} at {word()}. {word()}", lambda: f"{num(3)} {num(5)} {num(2)} {num(7)}", lambda: f"@{word()}{num(3)}", lambda: f"{num(2)}.{num(3)}.{num(3)},{num(2)}", lambda: f"{300 + int(num(2))}.{num(2)}.{num(3)}.{num(2)}",
        lambda: f"{r.choice(('commit ', 'sha256 ', 'md5: ', 'build ', 'checksum '))}{of('0123456789abcdef', r.choice((32, 40, 64)))}", lambda: f"{r.choice('$€')}{first(r.randint(1, 3))},{num(3)}", lambda: f"{first(r.randint(1, 3))}{r.choice(' ,.')}{num(3)}{r.choice(' ,.')}{num(3)}", lambda: f"{num(2)}:{num(2)}:{num(2)}", lambda: f"{year()} {year()}", lambda: f"{year()}-{year()}",
        lambda: f"isbn 978-{num(1)}-{num(2)}-{num(6)}-{num(1)}", lambda: f"{first(2)}.{num(4)}, {first(2)}.{num(4)}", lambda: f"v{num(1)}.{num(2)}.{num(1)}", lambda: f"{r.choice(('order ', 'invoice no. ', 'id ', 'ticket ', 'version ', 'page ', 'No. '))}{first(r.randint(3, 12))}", lambda: f"{first(r.randint(1, 4))} {word()} {first(r.randint(1, 4))}",
        lambda: " ".join(first(r.randint(1, 4)) for _ in range(r.randint(2, 9))), lambda: "-".join((of("0123456789abcdef", 8), of("0123456789abcdef", 4), of("0123456789abcdef", 4), of("0123456789abcdef", 4), of("0123456789abcdef", 12))), lambda: f"{word()}-{word()}-{word()}-{word()}-{word()}-{word()}-{num(2)}",
        lambda: f"https://{host()}/{word()}/{num(4)}/{word()}-{word()}-{word()}.html", lambda: f"{word()} at {host()}", lambda: f"the {r.choice(('token', 'password', 'secret', 'key'))} {word()}", lambda: f"{word()}::{word()}", lambda: f"{word()}{num(1)}::{word()}{num(1)}", lambda: f"{num(2)}:{num(2)}", lambda: f"{of(upper, 2)}{num(2)} {first(4)} {num(4)} {num(4)} {num(4)}", lambda: f"{of(upper, 3)}-{num(4)}-{num(4)}",
        lambda: f"{first(3)} {num(3)}", lambda: f"{first(1)}. {word()}", lambda: f"{num(2)}.{num(2)}.{year()}", lambda: f"{first(2)}%", lambda: f"{word().title()} {first(2)}, {num(5)} {word().title()}", lambda: f"{word()} dot {word()}", lambda: f"{word()}: {word()}: {word()}", lambda: f"{r.choice(('a', 'one', 'my'))} {r.choice(('call', 'mail', 'card', 'phone'))} {first(r.randint(1, 3))} {word()}",
    )
    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(r.randint(2, 4)):
            text += " ".join(word() for _ in range(r.randint(1, 4))) + r.choice((" ", " ", ": ", ", "))
            if r.random() < 0.55:
                k = r.randrange(len(with_cue))
                lead, s = with_cue[k]()
                text += lead
                spans.append((len(text), len(text) + len(s), k))
                text += s + ('"' if lead.endswith('"') else ")" if lead.endswith("(") else "")
            else:
                text += r.choice(decoys)()
            text += r.choice((" ", ". ", ", ", "\n"))
        out.append((text + word(), spans))
    return out


def _logsumexp(x: list[float]) -> float:
    m = max(x)
    return m + math.log(sum(math.exp(v - m) for v in x))


@lru_cache(maxsize=2)
def trained(seed: int = 7, sentences: int = TRAIN_SENTENCES, rounds: int = 60, ridge: float = 0.03) -> np.ndarray:
    """Weights, kinds by features, of maximum regularised likelihood (Adam on the whole sample); a token outside entities scores 0."""
    rows, number = [], {}
    chains = []
    for text, spans in _sentences(sentences, seed):
        gold = {(a, b): k for a, b, k in spans}
        for a, b in windows(text):
            tokens, cands = lattice(text, a, b, [])
            if not cands:
                continue
            for _, _, key in cands:
                if key not in number:
                    number[key] = len(rows)
                    rows.append(_features(*key))
            kinds = [gold.get((tokens[i][0], tokens[j - 1][1]), -1) for i, j, _ in cands]
            chains.append((len(tokens), [(i, j) for i, j, _ in cands], np.array([number[key] for _, _, key in cands]), kinds))
    f = np.array(rows)
    want = np.zeros((len(rows), len(KINDS)))
    for _, _, at, kinds in chains:
        for x, k in zip(at, kinds, strict=True):
            if k >= 0:
                want[x, k] += 1
    w = np.zeros((len(KINDS), len(FEATURES)))
    w[:, 0] = -2.0
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        s = f @ w.T
        top = s.max(1, keepdims=True)
        e = np.exp(s - top)
        seg = (top[:, 0] + np.log(e.sum(1))).tolist()
        within = e / e.sum(1, keepdims=True)  # of the kinds, given the segment
        had = np.zeros(len(rows))
        for n, ends, at, _ in chains:
            score = [seg[x] for x in at]
            by_end: dict[int, list[int]] = {}
            by_start: dict[int, list[int]] = {}
            for x, (i, j) in enumerate(ends):
                by_end.setdefault(j, []).append(x)
                by_start.setdefault(i, []).append(x)
            fwd, bwd = [0.0] * (n + 1), [0.0] * (n + 1)
            for t in range(1, n + 1):
                fwd[t] = _logsumexp([fwd[t - 1], *(fwd[ends[x][0]] + score[x] for x in by_end[t])]) if t in by_end else fwd[t - 1]
            for t in range(n - 1, -1, -1):
                bwd[t] = _logsumexp([bwd[t + 1], *(bwd[ends[x][1]] + score[x] for x in by_start[t])]) if t in by_start else bwd[t + 1]
            np.add.at(had, at, [math.exp(score[x] + fwd[i] + bwd[j] - fwd[n]) for x, (i, j) in enumerate(ends)])
        grad = ((want - had[:, None] * within).T @ f - ridge * w) / len(chains)
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        w += 0.4 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-9)
    return w


def find(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, added spans); an added span overlaps no base span."""
    base = base_spans(text)
    return base, decode(text, field, base)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


_COUNTS = ("n_email", "n_ip", "n_card", "n_phone")


def find_personal(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of df: key, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added, n_spans, has_personal.

    spans: base and added spans as kind:start:end in code points, by kind (email, ip, card, phone, secret, account), then start;
    n_spans counts them. A null or empty text has none; whole texts are read; repeated rows are read each; an empty table gives
    no rows; other columns are not read.
    """
    weights = trained()
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", base_sha256 string, spans string, n_added bigint, n_spans bigint, has_personal boolean"

    def run(batches):
        field = Field(weights)
        for b in batches:
            n, sha, spans, more = [], [], [], []
            for t in b.column(1):
                base, added = find(t.as_py() or "", field)
                n.append([sum(k == i for k, _, _ in base) for i in range(4)])
                sha.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(base + added))
                more.append(len(added))
            counts = np.array(n, np.int64).reshape(-1, 4)
            added_n = np.array(more, np.int64)
            every = counts.sum(axis=1) + added_n
            cols = [b.column(0), *(pa.array(counts[:, i]) for i in range(4)), pa.array(sha, pa.string()), pa.array(spans, pa.string()), pa.array(added_n), pa.array(every), pa.array(every > 0)]
            yield pa.RecordBatch.from_arrays(cols, names=[key, *_COUNTS, "base_sha256", "spans", "n_added", "n_spans", "has_personal"])

    return df.select(df[key], df[text]).mapInArrow(run, schema)
