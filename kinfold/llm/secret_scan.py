"""Secret scan: fixed patterns plus dictionary-primed zstandard novelty.

The patterns find assignments to sensitive names, access key ids and long hex runs. **Novelty** adds what no pattern
describes: a candidate is an unbroken run of key characters (or several with single dots between) that stands in a sensitive
context (a sensitive word shortly before it, on its own or inside an identifier such as ``dbPassword`` or ``X-AuthToken``). It is compressed with a zstandard dictionary made of common identifiers and the code or prose
around it. The bytes that it adds to an empty frame are its marginal cost: words, paths and identifiers that occur
around it cost little, while a random string costs about its own length. Only candidates whose cost is at least
``NOVEL_SHARE`` of their length are reported. A candidate is costed in pieces of at most ``PIECE`` characters, because
longer ones are Huffman-coded, by which a random string of a small alphabet (hex, base32) gets cheaper too. What the
context shares with the candidate is left out of the dictionary (a key written twice is as novel as one written
once). Long words have no digits and cost their length too where the dictionary lacks them, so a candidate without a
digit must also be likelier as random letters than under letter pairs of common words. Dates, and paths and names whose every part is short
or like words, are no candidates; identifiers of random hex digits (UUIDs) are.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .batches import with_columns

KINDS = ("assign", "access", "hex", "novel")
#: re.ASCII: only ASCII letters have a second case.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: A run of key characters; dots inside it join its parts (a token in three dotted parts is judged as one).
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]++(?:\.[A-Za-z0-9+/_=-]++)*+")
SENSITIVE = re.compile(r"(?<![a-z])(pass(word|wd|phrase)?|pwd|secret|token|api.?key|access.?key|private.?key|auth|authorization|bearer|credential|signature|license.?key|client.?id)s?(?![a-z])", re.A)
#: Where a new word begins inside an identifier.
HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", re.A)
DATE = re.compile(r"(19|20)\d\d([-/._]?)[01]\d\2[0-3]\d[T_.Z\d+-]*", re.A)
SENSITIVE_BEFORE = 48
CONTEXT = 512
NOVEL_SHARE = 0.8
#: zstandard Huffman-codes literals from 64 bytes on.
PIECE = 63
#: Characters in a row that are another copy of (a part of) the candidate; no candidate is shorter.
SHARED = 16

#: Common words of code and configuration, as a dictionary for the compressor.
IDENTIFIERS = " ".join((
    "abstract access account address application argument array async attribute authorization await base64 boolean buffer "
    "callback channel character class client collection column command component config configuration connection const "
    "constructor container content context control controller count create credentials current database datetime default "
    "define delete description destination development directory document double element environment error event exception "
    "execute export extends factory false field filename filter float folder format function generate getElementById handler "
    "header height hostname identifier implements import index initialize input insert instance integer interface internal "
    "iterator javascript keyboard language length library listener localhost location manager message metadata method model "
    "module namespace network number object operator option output override package parameter parent password path pattern "
    "permission pointer position primary private process production program property protected provider public python query "
    "queue random receive record reference register release remove repository request resource response result return "
    "schema screen script search secret section security select sequence server service session setting signature source "
    "standard static status storage stream string struct structure support switch synchronized system template terminal "
    "testing thread timeout timestamp token transaction transform undefined undo update username utils validate value "
    "variable version virtual visible void volatile warning website width window worker abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 xxxxxxxxxxxxxxxx ================ ---------------- ________________ "
    "http://www.example.com https://").split()).encode()

#: Bits by which words must be likelier than random letters.
WORD_BITS = 3.0
#: Common words of the languages of the documents; with the identifiers, their letter pairs tell words from random letters.
WORDS = (
    "the and that have for not with you this but his from they say her she will one all would there their what out about who get which when make "
    "can like time just him know take people into year your good some could them see other than then now look only come its over think also back "
    "after use two how our work first well way even new want because any these give day most government information important development "
    "international organization responsibilities characteristics understanding interesting through without between something everything "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur se ne ce avec il sont mais nous vous comme tout fait leur bien "
    "toujours aussi entre depuis encore avant pendant beaucoup gouvernement naturellement particulierement connaissance quelque lesquelles "
    "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am "
    "sind noch wie einem haben nur oder aber vor zur bis mehr durch man sein wurde sei schon wenn zwischen verschiedene gesellschaft "
    "wissenschaftlichen entwicklung moeglichkeiten verantwortung geschwindigkeit nachrichten aufgrund rechtschreibung "
    "el los del las por con una para como pero sus al lo mas este si porque esta cuando muy sin sobre ser tiene tambien hasta hay donde quien "
    "desde todo nos durante todos uno les ni contra otros ese eso ante ellos entonces informacion desarrollo naturaleza conocimiento "
    "responsabilidad caracteristicas administracion importante internacional password login username filename database").split()


def _letter_pairs() -> dict[str, float]:
    """Bits by which each letter is cheaper after its predecessor (a space at a word's start) than a random letter."""
    pairs: Counter = Counter()
    for w in [*WORDS, *(w for w in re.findall(r"[a-z]+", IDENTIFIERS.decode()) if len(set(w)) < 26 and len(set(w)) > 1)]:
        pairs.update(x + y for x, y in zip(" " + w, w, strict=False))
    letters = "abcdefghijklmnopqrstuvwxyz"
    after = {x: sum(pairs[x + y] for y in letters) for x in " " + letters}
    return {x + y: math.log2(26 * (pairs[x + y] + 0.5) / (after[x] + 13)) for x in " " + letters for y in letters}


PAIRS = _letter_pairs()


def like_words(candidate: str) -> bool:
    """Whether a candidate without a digit is likelier as words than as random letters; so must be each of its long parts."""
    parts = re.findall(r"[a-z]+", candidate.lower())
    bits = [sum(PAIRS[x + y] for x, y in zip(" " + p, p, strict=False)) for p in parts]
    return sum(bits) > WORD_BITS and all(n > WORD_BITS for n, p in zip(bits, parts, strict=True) if len(p) >= 8)


def plain_name(candidate: str) -> bool:
    """Whether a candidate is a date, or a path, name or version whose every part is short or like words."""
    if DATE.fullmatch(candidate):
        return True
    parts = re.split(r"[/._=+-]+", candidate)
    return len(parts) > 1 and all(len(p) <= 4 or like_words(p.rstrip("0123456789")) and len(p) - len(p.rstrip("0123456789")) <= 4 for p in parts)


def in_context(text: str, at: int) -> bool:
    """Whether a sensitive word stands shortly before ``at``, on its own or inside an identifier."""
    before = text[max(0, at - SENSITIVE_BEFORE - 1):at]
    # the first character only tells whether a word begins after it
    m = SENSITIVE.search(HUMP.sub("_", before).lower(), 0 if at <= SENSITIVE_BEFORE else 1)
    return m is not None


def other_text(text: str, a: int, b: int) -> str:
    """The text around [a, b), with all that it shares with the candidate there (runs of ``SHARED``) blanked."""
    word = text[a:b]
    grams = {word[i:i + SHARED] for i in range(len(word) - SHARED + 1)}

    def blanked(side: str) -> str:
        out, end = [], 0
        for i in range(len(side) - SHARED + 1):
            if side[i:i + SHARED] in grams:
                out.append(side[end:i])
                out.append(" " * (i + SHARED - max(i, end)))
                end = i + SHARED
        return "".join([*out, side[end:]])

    # a copy across the window's edge is seen whole
    left, right = text[max(0, a - CONTEXT - SHARED):a], text[b:b + CONTEXT + SHARED]
    return blanked(left)[-CONTEXT:] + " " + blanked(right)[:CONTEXT]


def marginal_bytes(candidate: bytes, context: bytes) -> int:
    """Bytes that ``candidate``, in equal pieces, adds to frames whose dictionary is the identifiers and the context."""
    prime = zstandard.ZstdCompressionDict(IDENTIFIERS + b" " + context, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=3, dict_data=prime, write_content_size=False, write_checksum=False, write_dict_id=False)
    n = -(-len(candidate) // PIECE)
    cuts = [len(candidate) * i // n for i in range(n + 1)] if n else []
    return sum(len(packer.compress(candidate[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)) - n * len(packer.compress(b""))


def find_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of every span in the whole text, sorted; code points, end exclusive."""
    if not text:
        return []
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    taken: list[list[int]] = []  # the base spans, joined where they overlap
    for a, _, b in sorted(spans):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    near = 0
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        while near < len(taken) and taken[near][1] <= a:
            near += 1
        if b - a < SHARED or near < len(taken) and taken[near][0] < b:
            continue
        word = m[0]
        if not in_context(text, a):
            continue
        if not any(c.isdigit() for c in word) and like_words(word) or plain_name(word):
            continue
        if marginal_bytes(word.encode(), other_text(text, a, b).encode("utf-8", "surrogatepass")) >= NOVEL_SHARE * len(word):
            spans.append((a, 3, b))
    return sorted(spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with every (possibly overlapping) span replaced by ``mark``."""
    out, at = [], 0
    for a, _, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """One row for each input row: id, n_assign, n_access, n_hex, n_novel, base_spans, spans, redacted.

    base_spans (assign, access, hex) and spans (those and novel) read kind:start:end, by start and then kind,
    comma-joined. ``redacted`` is the whole text with the spans replaced, NULL where there is none. With ``carry``, the
    input row comes as the struct ``row`` in place of the id. NULL and empty texts have no spans. Ids may be NULL or
    repeat; an empty table gives an empty result. No shuffle: each row is scanned where it is read, in bounded
    slices. Other columns of ``df`` are not looked at.
    """
    def said(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)

    def compute(texts: list) -> list[pa.Array]:
        found = [find_spans(t) for t in texts]
        counts = [[sum(k == wanted for _, k, _ in f) for f in found] for wanted in range(4)]
        return [*(pa.array(c, type=pa.int64()) for c in counts),
                pa.array([said([s for s in f if s[1] < 3]) for f in found], type=pa.string()), pa.array([said(f) for f in found], type=pa.string()),
                pa.array([redact(t, f) if f else None for t, f in zip(texts, found, strict=True)], type=pa.string())]

    return with_columns(df, id_col, text_col, "n_assign long, n_access long, n_hex long, n_novel long, base_spans string, spans string, redacted string",
                        ["n_assign", "n_access", "n_hex", "n_novel", "base_spans", "spans", "redacted"], lambda: compute, carry)

