"""Problem 1: sentence boundaries in any language and script.

A hidden-event n-gram language model runs over words (or their classes), gaps and boundary events; forward-backward sums over
all ways to place events give each gap's posterior, and one half decides. There are two of them, both trained on all texts,
labelled by the rules of `annotate`: one on the texts as they are, for paragraphs with final
marks, in which an event may stand after any mark that Unicode knows to end sentences, and at a space between Thai letters; the other on
the same texts without those marks, for paragraphs that have none, in which one may stand at every gap between words, and between
letters of scripts that don't part words. Certain gaps are fixed by definition: an empty line always parts, the inside of a
quotation or bracket never does, nor a space beside a digit in Thai.

Events that are more symbols apart than the model's order are independent given the symbols between them, so only the
stretches around gaps are summed over, and equal stretches once.

Words and n-grams are counted over every row, by 64-bit hashes. A block of rows is joined with the counts that its stretches
may ask for, so no task and no driver holds the whole model; the driver gets the hashes of the known words alone.

Defined results: null, empty and blank texts have no sentences; repeated rows are split each; positions count code points.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.runtime import cut

#: The order of the language model, and how often a word must occur to be one of its own.
ORDER, WORD_LEAST = 6, 2
#: The order of the model of texts without marks, and the n-grams' length from which those seen once are left out of both.
BARE_ORDER, RARE_FROM = 4, 4
#: Symbols, white space aside, that a paragraph without marks must have to be split, and the posterior that splits it.
BARE_LEAST, BARE_POSTERIOR = 12, 0.8
#: Stretches whose posteriors a worker keeps, and pieces of text, words and probabilities that it does.
HELD_STRETCHES, HELD = 50_000, 200_000
#: Symbols that are counted at once, and n-grams and words that a task holds before it passes their counts on.
BLOCK_SYMBOLS, HELD_GRAMS, HELD_WORDS = 400_000, 1_500_000, 1_000_000
#: Letters of texts whose words are looked up at once, and bits of the places for the words met last.
BLOCK_LETTERS, WORD_BITS = 1 << 19, 18
#: Bits of the largest filter of the n-grams that are asked for, as a power of two; when it fills up, more that aren't are counted too.
FILTER_BITS = 28
#: Rows whose stretches are looked up and summed over together.
BLOCK_ROWS = 2_000

# Marks that end a sentence in some script (Unicode's property Sentence_Terminal within the basic plane, Khmer's and the ellipsis).
FINALS = ".!?…։؝؞؟۔܀܁܂߹࠷࠹࠽࠾।॥၊။።፧፨᙮᜵᜶។៕᠃᠉᥄᥅᪨᪩᪪᪫᭚᭛᭞᭟᰻᰼᱾᱿‼‽⁇⁈⁉⸮⸼。꓿꘎꘏꛳꛷꡶꡷꣎꣏꤯꧈꧉꩝꩞꩟꫰꫱꯫﹒﹖﹗！．？｡"
#: Those of scripts that put no space after them.
IDEOGRAPHIC_FINALS = "。！？｡．।॥။។៕።﹒﹖﹗꓿"
CLOSING = "”’»)]}」』）】》〉\"'"
PAIRS = {"“": "”", "«": "»", "「": "」", "『": "』", "（": "）", "(": ")", "[": "]", "【": "】", "《": "》", "〈": "〉", "‘": "’"}

# Abbreviations that take a full stop and don't end a sentence, by language.
ABBREVIATIONS = set(
    "TP Tp tp ThS Ths PGS GS TS BS KS CN LS NXB Nxb tr Tr ĐT Đt STT "
    "Dr Mr Mrs Ms Prof St No Nos no Art Arts art arts Reg Regs Dept Depts Sec Secs sec Fig fig cf Cf p pp approx vol Vol ed eds ca viz vs Inc Ltd Jr Sr Gen Col Rev Hon "
    "M MM Mme Mlle Me al n av bd chap ch cap éd "
    "п ст гл т г гг ул д пос стр рис см др проф им обл руб тыс "
    "डॉ श्री प्रो".split()
)
# Words that a heading's number follows.
HEADINGS = "Điều|Khoản|Mục|Chương|Phần|Tiểu mục|Phụ lục|Bước|Câu|Article|Art|Section|Chapter|Part|Annex|Chapitre|Annexe|Статья|Глава|Раздел|Пункт|अनुच्छेद|ข้อ|第|제"
_LABEL = re.compile(rf"^\W*(?:(?:{HEADINGS})\s*)?(?:\d{{1,3}}(?:\.\d{{1,3}})*|[IVXLC]{{1,6}}|[^\W\d_])[.)]?$", re.I)
_QUOTES = re.compile(f"[{re.escape(''.join(PAIRS) + ''.join(PAIRS.values()))}\"]")
_STOP = re.compile(f"[{re.escape(FINALS)}]+")
#: Scripts that don't part words: each of their letters, with its marks, is a word of a text without final marks.
_UNSPACED = "[ก-ะเ-ๆ\u0e80-\u0ec6\u1000-\u102a\u1780-\u17b3\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]"
#: Signs that stand on a letter and belong to its word.
_SIGNS = "\u0300-\u036f\u0591-\u05bd\u0610-\u061a\u064b-\u065f\u0900-\u0963\u0e31\u0e34-\u0e3a\u0e47-\u0e4e\u0eb1\u0eb4-\u0ebc\u0ec8-\u0ecd\u102b-\u103e\u135d-\u135f\u17b4-\u17d3"
_TOKEN = re.compile(rf"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:[{_SIGNS}]+[^\W\d_]*)*|\s+|[^\w\s]|_", re.S)
_BARE_TOKEN = re.compile(rf"\d+(?:[.,:/]\d+)*|{_UNSPACED}[{_SIGNS}]*|(?:(?!{_UNSPACED})[^\W\d_])+(?:[{_SIGNS}]+(?:(?!{_UNSPACED})[^\W\d_])*)*|\s+|[^\w\s]|_", re.S)
_BLANK = re.compile(r"[^\S\n]*\r?\n(?:[^\S\n]*\r?\n)+\s*")
_BLANK_LINE = re.compile(r"\n[^\S\n]*\n")
_HEADING_WORD = re.compile(rf"(?<!\w)(?:{HEADINGS})\s*$", re.I)
_NUMBER_END = re.compile(r"(?<![\w.,:/])\d{1,3}$")
_THAI = re.compile("[฀-๿]")
_PIECE = re.compile(r"\S+\s*")
_SPACE = re.compile(r"\s*")
_ANY_UNSPACED = re.compile(_UNSPACED)
#: A letter of a script that doesn't part words or has no case, or one beside them.
_OTHER = re.compile("[\u0590-\u1dff\u2e80-\U0010ffff]")
_INITIAL = re.compile(r"(?:^|[^\w])(?:[^\W\d_]\.)*[^\W\d_]$")


def _thai(c: str) -> bool:
    return "฀" <= c <= "๿" and not c.isdigit()


def closed_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of quotations and brackets that are closed within their paragraph; the outermost ones."""
    if not _QUOTES.search(text):
        return []
    spans, stack, straight = [], [], -1
    ends = [m.start() for m in _BLANK.finditer(text)] + [len(text)] if _BLANK_LINE.search(text) else [len(text)]
    k = 0
    for m in _QUOTES.finditer(text):
        i, c = m.start(), m.group()
        while i >= ends[k] and k < len(ends) - 1:
            k, stack, straight = k + 1, [], -1
        if c in PAIRS:
            stack.append((PAIRS[c], i))
        elif c == '"':
            if straight >= 0:
                spans.append((straight, i + 1))
                straight = -1
            else:
                straight = i
        else:
            at = next((j for j in range(len(stack) - 1, -1, -1) if stack[j][0] == c), -1)
            if at >= 0 and not (c == "’" and i + 1 < len(text) and text[i + 1].isalpha()):
                spans.append((stack[at][1], i + 1))
                del stack[at:]
    outer: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if not outer or s >= outer[-1][1]:
            outer.append((s, e))
    return outer


def bare_paragraphs(text: str) -> list[tuple[int, int]]:
    """(start, end) of the paragraphs without final marks that are long enough to hold several sentences."""
    out, at = [], 0
    for m in [*_BLANK.finditer(text), None]:
        end = m.start() if m else len(text)
        part = text[at:end]
        if not _STOP.search(part) and len(part) > BARE_LEAST and sum(not x.isspace() for x in _BARE_TOKEN.findall(part)) >= BARE_LEAST:
            out.append((at, end))
        at = m.end() if m else end
    return out


def bare_candidates(text: str) -> list[tuple[int, int, int]]:
    """As candidates, of a paragraph without final marks: every gap between words, and between letters of unspaced scripts."""
    toks = tokens(text, True)
    inside = bytearray(len(text) + 1)
    for s, e in closed_spans(text):
        inside[s + 1 : e] = b"\1" * (e - s - 1)
    found = []
    unspaced = False
    for x, s, e in toks:
        before, unspaced = unspaced, _ANY_UNSPACED.match(x) is not None
        if before and unspaced and not inside[s]:
            found.append((s, s, 0))
    for k in range(1, len(toks) - 1):
        x, s, e = toks[k]
        if x.isspace() and not inside[s]:
            a, b = toks[k - 1][0], toks[k + 1][0]
            if _parts(a[-1], b[0]):
                digit = a[-1].isdigit() or b[0].isdigit()
                found.append((s, e, -1 if digit and (_thai(a[-1]) or _thai(b[0])) else 0))
    return sorted(found)


def _stops(text: str) -> list[tuple[int, int]]:
    """(start, end) of the marks that don't stand at the text's end or inside a word or number."""
    found = ((m.start(), m.end()) for m in _STOP.finditer(text))
    return [(s, e) for s, e in found if e < len(text) and not (text[e].isalnum() and text[e].isascii() and text[e - 1] not in IDEOGRAPHIC_FINALS)]


def candidates(text: str, stops: list[tuple[int, int]] | None = None, quoted: bool = True) -> list[tuple[int, int, int]]:
    """(end, next, certainty) of gaps where a sentence may end: the end of its last visible character, the start of what
    follows, and 1 if it must end there, -1 if not, 0 if the model decides.

    stops: those of the text, where they are known and it has no Thai; quoted: whether it may have quotations or brackets."""
    inside = bytearray(len(text) + 1)
    for s, e in closed_spans(text) if quoted else ():
        inside[s + 1 : e] = b"\1" * (e - s - 1)
    thai = stops is None and _THAI.search(text)
    found: dict[int, tuple[int, int]] = {}
    for m in _BLANK.finditer(text) if _BLANK_LINE.search(text) else ():
        end = m.start() + len(m.group()) - len(m.group().lstrip())
        if m.end() < len(text) and text[: m.start()].strip():
            found[m.start()] = (m.end(), 1)
    for start, stop in _stops(text) if stops is None else stops:
        end = stop
        while end < len(text) and (text[end] in CLOSING or text[end] in "   " and text[end + 1 : end + 2] == "»"):
            if text[end] in "\"'" and not inside[end]:
                break
            end += 1
        nxt = end
        while nxt < len(text) and text[nxt].isspace():
            nxt += 1
        if nxt >= len(text) or inside[end]:
            continue
        ideographic = text[stop - 1] in IDEOGRAPHIC_FINALS
        if nxt == end and not ideographic and not (unicodedata.category(text[nxt])[0] == "P" and text[nxt] in PAIRS and text[stop - 1] in "!?…") and not ("⺀" <= text[nxt] <= "鿿" or "가" <= text[nxt] <= "힣"):
            if not (end > stop and text[nxt] in PAIRS):
                continue
        found.setdefault(end, (nxt, -1 if end == stop and _opening_number(text, start) else 0))
    for m in re.finditer(r"\s+", text) if thai else ():
        a, b = m.start() - 1, m.end()
        if a >= 0 and b < len(text) and _thai(text[a]) and not inside[m.start()] and not text[b].isdigit() and m.start() not in found and (text[b].isalpha() or text[b] in PAIRS):
            found[m.start()] = (b, 0)
    return sorted((end, nxt, c) for end, (nxt, c) in found.items())


def _opening_number(text: str, stop: int) -> bool:
    """Whether a number before the stop opens a sentence, as a label does: after a final mark, an empty line or nothing."""
    number = _NUMBER_END.search(text, max(0, stop - 4), stop) if stop and (text[stop - 1].isdecimal() or text[stop - 1] == "\n") else None
    if not number:
        return False
    before = text[: number.start()]
    heading = _HEADING_WORD.search(before[-24:])
    if heading:
        before = before[: len(before) - len(heading.group())]
    bare = before.rstrip()
    if not bare or before[len(bare) :].count("\n") > 1:
        return True
    if len(bare) == len(before):
        return False
    core = bare.rstrip(CLOSING)
    if core[-1:] not in FINALS:
        return False
    word = re.search(r"[^\s(“«]*$", core[-14:-1]).group()
    return core[-1] != "." or len(core) < len(bare) or word.lower() in ("v.v", "etc") or not (word in ABBREVIATIONS or len(word) == 1)


def annotate(text: str) -> list[int]:
    """Ends of the sentences of a text by rule: the labels that the language model is trained on."""
    return _annotated(text, candidates(text))


def _annotated(text: str, found: list[tuple[int, int, int]]) -> list[int]:
    ends, start = [], 0
    for end, nxt, certain in found:
        if certain > 0 or certain == 0 and _ends(text, start, end, nxt):
            ends.append(end)
            start = nxt
    last = len(text.rstrip())
    return ends + [last] if last > start else ends


def _ends(text: str, start: int, end: int, nxt: int) -> bool:
    unit, c = text[start:end], text[nxt]
    if _thai(unit[-1:] or " "):
        return True
    closers = len(unit) - len(unit.rstrip(CLOSING + "   "))
    core = unit[: len(unit) - closers]
    mark = core[-1:]
    if c.islower() or c in ",;:—–" or c == "-" and text[nxt + 1 : nxt + 2] == " " and closers:
        return False
    if mark in "।॥" or mark not in ".!?…" and mark not in IDEOGRAPHIC_FINALS:
        return True
    if mark in IDEOGRAPHIC_FINALS:
        return not (closers and (("ぁ" <= c <= "ゟ") or text.startswith(("随后", "然后", "隨後", "一事", "等", "的", "之"), nxt)))
    if closers and "가" <= c <= "힣" and nxt == end:
        return False
    if mark == ".":
        word = core.rstrip(".…")
        line = word.removesuffix("\n")
        at = len(line)
        while at and line[at - 1] not in "(“«\"'’" and not line[at - 1].isspace():
            at -= 1
        stem = line[at:]
        if _LABEL.match(word.strip()):
            return False
        if not closers and core.endswith("...") is False:
            if stem in ABBREVIATIONS or stem.split("'")[-1] in ABBREVIATIONS or stem.split("’")[-1] in ABBREVIATIONS:
                return False
            if stem.lower() in ("v.v", "etc", "a.m", "p.m", "v.v..."):
                return True
            if len(stem) < 12 and stem and not stem[-1].isdigit() and _INITIAL.search(stem) and (len(stem) == 1 or "." in stem):
                return False
            if len(stem) in (2, 3) and unicodedata.category(stem[-1])[0] == "M" and unicodedata.category(stem[0])[0] == "L" and len([x for x in stem if x.isalpha()]) == 1:
                return False
    return True


# The language model.

START = "<s>"


#: Scripts without case that are told apart; words of any other are of one class, so that what is learnt of one holds for all.
OWN_SCRIPTS = {"CJK", "HIRA", "KATA", "HANG", "THAI"}
_CASELESS = re.compile("[\u0590-\u0dff\u0e80-\u109f\u1200-\u137f\u1780-\u17ff]")
#: Marks that the models don't know are read as those of the same use that they do.
ALIKE = {c: "?" for c in "؟՞⁇⁈⁉⸮﹖"} | {c: "!" for c in "‼﹗"} | {c: "。" for c in "﹒꓿"} | {c: "।" for c in FINALS if c not in ".!?…。！？｡．।॥؟՞⁇⁈⁉⸮﹖‼﹗﹒꓿"}


def _shape(word: str) -> str:
    c = word[0]
    if c.isdigit():
        return "0" if word.isdigit() and len(word) <= 3 else "0000" if word.isdigit() else "0.0"
    if not c.isalpha():
        return word
    script = _script(ord(c))
    if len(word) == 1 and (c.isupper() or c.islower() or script in OWN_SCRIPTS):
        return f"{script}1{'U' if c.isupper() else 'l'}"
    if not c.isupper() and not c.islower() and script not in OWN_SCRIPTS:
        return "caseless" + ("1" if len(word) == 1 else "")
    case = "AA" if word.isupper() else "A" if c.isupper() else "a" if c.islower() else ""
    return script + case


@functools.lru_cache(200_000)
def _script(cp: int) -> str:
    if cp < 0x250 or 0x1E00 <= cp < 0x1F00:
        return "L"
    return unicodedata.name(chr(cp), "X").split(" ")[0][:4]


def tokens(text: str, bare: bool = False) -> list[tuple[str, int, int]]:
    """(token, start, end), white space included."""
    return [(m.group(), m.start(), m.end()) for m in (_BARE_TOKEN if bare else _TOKEN).finditer(text)]


def _gap(space: str) -> str:
    return "¶" if space.count("\n") > 1 else "/" if "\n" in space else "_"


#: An n-gram's key is that of its first symbols times MIX plus its last symbol's hash, in 64 bits; that of none is the model's.
#: What follows it is kept under its key with TOTAL's bits turned.
MIX, TOTAL, BITS = 0x9E3779B97F4A7C15, 0x5851F42D4C957F2D, (1 << 64) - 1
SEEDS = (0xD1B54A32D192ED03, 0xAEF17502108EF2D9)


@functools.lru_cache(HELD)
def _hash(symbol: str) -> int:
    return xxhash.xxh3_64_intdigest(symbol.encode("utf-8", "surrogatepass"))


@functools.lru_cache(HELD)
def _bytes(symbol: str) -> bytes:
    return _hash(symbol).to_bytes(8, sys.byteorder)


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


class Words:
    """The words that a model knows, as hashes in order."""

    def __init__(self, hashes: np.ndarray, bare: bool):
        self.hashes, self.bare, self.held = hashes, bare, {}

    @staticmethod
    def hash(word: str, bare: bool) -> int:
        return _signed(xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"), seed=SEEDS[bare]))

    def __contains__(self, word: str) -> bool:
        known = self.held.get(word)
        if known is None:
            x = self.hash(word, self.bare)
            k = int(np.searchsorted(self.hashes, x))
            known = word in ABBREVIATIONS or k < len(self.hashes) and int(self.hashes[k]) == x
            if len(self.held) < HELD:
                self.held[word] = known
        return known


#: Digits are alike to the models: pieces of text are looked up with zeros in their place, so that they needn't be read and held
#: for each number; with their own digits they are held besides, in half of the room.
ZEROS = str.maketrans("123456789", "0" * 9)


class Symbols(dict):
    """The hashes of the symbols of tokens."""

    def __init__(self, model: HiddenEventModel, known: bool):
        super().__init__()
        self.model, self.known = model, known

    def __missing__(self, token: str) -> bytes:
        out = _bytes(self.model.cls(token, self.known))
        if len(self) < HELD and len(token) < 64:
            self[token] = out
        return out


class Pieces(dict):
    """The hashes of the symbols of pieces of text, each white space at most at its end."""

    def __init__(self, model: HiddenEventModel, known: bool, spaced: bool):
        super().__init__()
        self.symbols, self.spaced = Symbols(model, known), spaced
        self.tokens = (_BARE_TOKEN if model.bare else _TOKEN).findall

    def __missing__(self, piece: str) -> bytes:
        alike = piece.translate(ZEROS)
        if alike != piece:
            out = self[alike]
            if 2 * len(self) < HELD and len(piece) < 64:
                self[piece] = out
            return out
        word = piece.rstrip()
        out = b"".join(map(self.symbols.__getitem__, self.tokens(word)))
        if len(word) < len(piece):
            gap = _gap(piece[len(word) :])
            if self.spaced or gap != "_" or out[-8:] != _DANDA:
                out += _bytes(gap)
        if len(self) < HELD and len(piece) < 64:
            self[piece] = out
        return out


class HiddenEventModel:
    """Interpolated (Witten-Bell) n-gram model over word classes, gaps and the boundary event S.

    facts: by key, (count, 0) of an n-gram, and (count, kinds) of what follows one.
    """

    def __init__(self, words: set[str] | Words, order: int = ORDER, bare: bool = False):
        self.words, self.order, self.bare = words, order, bare
        self.held: dict[tuple, list[float]] = {}
        self.probs: dict[tuple, float] = {}
        self.steps: dict[tuple, tuple] = {}
        self.pieces = Pieces(self, True, True), Pieces(self, False, True), Pieces(self, False, False)
        self.facts: dict[int, tuple[int, int]] = {}

    def cls(self, token: str, known: bool = True) -> str:
        return token if token[0].isalpha() and token in (self.words if known else ABBREVIATIONS) else ALIKE.get(token, token) if not token[0].isalnum() else _shape(token)

    def lattice(self, text: str, gaps: dict[int, int], known: bool = True) -> list[tuple[tuple[str, ...], tuple[str, ...] | None, int]]:
        """Per step the symbols without an event, the symbols with one (None: no choice) and the gap's end position."""
        steps: list = []
        toks = tokens(text, self.bare)
        for k, (t, s, e) in enumerate(toks):
            if t.isspace():
                if s in gaps:
                    # a gap that is none for certain is another symbol, and says nothing of the others
                    g = _gap(t)
                    steps.append(((g + "-",), None, -1) if gaps[s] < 0 else ((g,), (g, "S"), s))
                elif 0 < k < len(toks) - 1:
                    steps.append(((_gap(t),), None, -1))
            else:
                step = self.steps.get((t, known))
                if step is None:
                    step = (self.cls(t, known),), None, -1
                    if len(self.steps) < HELD:
                        self.steps[t, known] = step
                steps.append(step)
                if gaps.get(e, -1) >= 0 and k + 1 < len(toks) and not toks[k + 1][0].isspace():
                    steps.append(((), ("S",), e))
        return steps

    def sequences(self, text: str, events: set[int], closed: set[int]):
        """Hashes of the symbols of a text, as the lattice has them, with the events after some ends; closed: gaps that are none
        for certain. Texts of caseless scripts count again with no word known, and without the space after a mark, for others of the kind."""
        last = len(text.rstrip())
        marked = [(e, _SPACE.match(text, e).end()) for e in sorted(events | closed) if 0 < e < last and not text[e - 1].isspace()]
        for pieces in self.pieces if _CASELESS.search(text) else self.pieces[:1]:
            seq, pos = [_START, _S], 0
            for e, nxt in marked:
                seq += map(pieces.__getitem__, _PIECE.findall(text, pos, e))
                if nxt > e:
                    gap = _gap(text[e:nxt])
                    if e in closed:
                        seq.append(_bytes(gap + "-"))
                    elif pieces.spaced or gap != "_" or seq[-1][-8:] != _DANDA:
                        seq.append(_bytes(gap))
                if e in events:
                    seq.append(_S)
                pos = nxt
            seq += map(pieces.__getitem__, _PIECE.findall(text, pos, last))
            seq.append(_S)
            yield b"".join(seq)

    def train(self, examples) -> None:
        """Counts of the n-grams of examples (text, ends of its sentences, gaps); called once."""
        grams = Grams()
        for text, ends, gaps in examples:
            grams.add(self, text, *_fixed(ends, gaps))
        g, h, c = grams.take()
        long = c < 0
        c = np.abs(c)
        keys, at = np.unique(g, return_inverse=True)
        total, kinds, rare = np.zeros(len(keys), np.int64), np.bincount(at, minlength=len(keys)), np.zeros(len(keys), bool)
        np.add.at(total, at, c)
        rare[at] = long
        self.facts = {k: (n, 0) for k, n, x in zip(h.tolist(), c.tolist(), long.tolist()) if n > 1 or not x}
        self.facts |= {k ^ TOTAL: (n, m) for k, n, m, x in zip(keys.tolist(), total.tolist(), kinds.tolist(), rare.tolist()) if n > 1 or not x}

    def keys(self, history: tuple[str, ...], symbol: str) -> tuple[int, int]:
        """Keys of the n-gram and of what follows the history."""
        key = SEEDS[self.bare]
        for s in history:
            key = (key * MIX + _hash(s)) & BITS
        return (key * MIX + _hash(symbol)) & BITS, key ^ TOTAL

    def prob(self, history: tuple[str, ...], symbol: str) -> float:
        found = self.probs.get((history, symbol))
        if found is None:
            key, under = self.keys(history, symbol)
            n, kinds = self.facts.get(under, (0, 0))
            # of no history, the kinds are the symbols
            found = self.prob(history[1:], symbol) if history else 1.0 / (kinds + 1)
            if n:
                found = (self.facts.get(key, (0, 0))[0] + kinds * found) / (n + kinds)
            if len(self.probs) < HELD:
                self.probs[history, symbol] = found
        return found

    def _follow(self, history: tuple[str, ...], symbols: tuple[str, ...]) -> tuple[tuple[str, ...], float]:
        p = 1.0
        for s in symbols:
            p *= self.prob(history, s)
            history = (*history, s)[-(self.order - 1) :]
        return history, p

    def posteriors(self, text: str, gaps: dict[int, int]) -> dict[int, float]:
        """Probability of a boundary at each gap (end position -> certainty), by forward-backward over the histories."""
        steps = self.lattice(text, gaps)
        reach, result = self.order - 1, {}
        options = [[plain] if event is None or gaps[at] < 0 else [event] if gaps[at] > 0 else [plain, event] for plain, event, at in steps]
        open_at = [k for k, o in enumerate(options) if len(o) > 1]
        k = 0
        while k < len(open_at):
            # a stretch: gaps that aren't parted by as many certain symbols as a history holds, and that many symbols after them
            first, last, after = open_at[k], open_at[k], 0
            j, end = k + 1, open_at[k] + 1
            while end < len(options) and after < reach:
                if len(options[end]) > 1:
                    last, after = end, 0
                    j += 1
                else:
                    after += len(options[end][0])
                end += 1
            history: list[str] = []
            for s in range(first - 1, -1, -1):
                history = [*options[s][0], *history] if len(options[s]) == 1 else history
                if len(history) >= reach:
                    break
            else:
                history = [START, "S", *history]
            key = (tuple(history[-reach:]), tuple(tuple(o) for o in options[first:end]), after < reach)
            p = self.held.get(key)
            if p is None:
                p = self._stretch(*key)
                if len(self.held) < HELD_STRETCHES:
                    self.held[key] = p
            for s, x in zip([s for s in range(first, last + 1) if len(options[s]) > 1], p):
                result[steps[s][2]] = x
            k = j
        for _, event, at in steps:
            if event is not None and gaps[at] > 0:
                result[at] = 1.0
        return result

    def _stretch(self, start: tuple[str, ...], options: tuple, closes: bool) -> list[float]:
        """Posteriors of the open gaps of a stretch after a history; closes: the text ends with it."""
        layers: list[dict[tuple[str, ...], float]] = [{start: 1.0}]
        arcs: list[list[tuple]] = []
        for choice in options:
            now: dict[tuple[str, ...], float] = {}
            out = []
            for h, p in layers[-1].items():
                for flag, symbols in enumerate(choice):
                    to, q = self._follow(h, symbols)
                    now[to] = now.get(to, 0.0) + p * q
                    out.append((h, to, q, flag))
            scale = sum(now.values()) or 1e-300
            best = max(now.values())
            layers.append({h: p / scale for h, p in now.items() if p >= 1e-9 * best})
            arcs.append(out)
        back = {h: self._follow(h, ("S",))[1] if closes else 1.0 for h in layers[-1]}
        result = []
        for k in range(len(options) - 1, -1, -1):
            before: dict[tuple[str, ...], float] = {}
            mass = [0.0, 0.0]
            for h, to, q, flag in arcs[k]:
                v = q * back.get(to, 0.0)
                before[h] = before.get(h, 0.0) + v
                mass[flag] += layers[k].get(h, 0.0) * v
            if len(options[k]) > 1:
                result.append(mass[1] / ((mass[0] + mass[1]) or 1e-300))
            scale = max(before.values()) or 1e-300
            back = {h: v / scale for h, v in before.items()}
        return result[::-1]


class Asking(HiddenEventModel):
    """Takes every n-gram as likely and keeps the keys of those it was asked for."""

    def __init__(self, *args):
        super().__init__(*args)
        self.asked: set[tuple] = set()
        self.new: list[int] = []

    def prob(self, history: tuple[str, ...], symbol: str) -> float:
        while (history, symbol) not in self.asked:
            self.asked.add((history, symbol))
            self.new += self.keys(history, symbol)
            if not history:
                break
            history = history[1:]
        return 1.0


def places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places of keys of what n-grams follow in a filter of so many bits, as a power of two."""
    return keys >> np.uint64(64 - bits)


def among(asked: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a filter holds; it holds all that were asked for, and few others."""
    at = places(keys, (8 * len(asked)).bit_length() - 1)
    return asked[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


def _once(t: pa.Table) -> pa.Table:
    """The n-grams of a table of (g, h, c) with their summed counts, each once: sorted by the first bits of h, the few that these don't tell apart grouped."""
    g, h, c = (t[k].to_numpy() for k in ("g", "h", "c"))
    if not len(h):
        return t
    bits = np.uint64(len(h).bit_length())
    at = h >> bits << bits | np.arange(len(h), dtype=np.uint64)
    at.sort()
    at = (at & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    g, h = g[at], h[at]
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])))
    out = pa.table([g[first], h[first], np.add.reduceat(c[at], first)], names=["g", "h", "c"])
    tops = h[first] >> bits
    alike = np.append(False, tops[1:] == tops[:-1])
    alike[:-1] |= alike[1:]
    if not alike.any():
        return out
    few = out.filter(pa.array(alike)).group_by(["g", "h"], use_threads=False).aggregate([("c", "sum")])
    return pa.concat_tables([out.filter(pa.array(~alike)), pa.table([few["g"], few["h"], few["c_sum"]], names=["g", "h", "c"])])


class Grams:
    """Counts of n-grams by key, with the key of what they follow; those of RARE_FROM symbols and more are negative.

    asked: the filter of what they may follow; without one, all are counted.
    """

    def __init__(self, asked: np.ndarray | None = None):
        self.asked = asked
        self.seqs: dict[bool, list[bytes]] = {False: [], True: []}
        self.sizes = {False: 0, True: 0}
        self.orders: dict[bool, int] = {}
        self.tables: list[pa.Table] = []

    def add(self, model: HiddenEventModel, text: str, events: set[int], closed: set[int]) -> None:
        for seq in model.sequences(text, events, closed):
            self.put(model, [seq])

    def put(self, model: HiddenEventModel, seq: list[bytes]) -> None:
        bare = model.bare
        self.orders[bare] = model.order
        self.seqs[bare] += seq
        self.sizes[bare] += sum(map(len, seq)) // 8
        if self.sizes[bare] >= BLOCK_SYMBOLS:
            self._count(bare)

    def _count(self, bare: bool) -> None:
        if not self.seqs[bare]:
            return
        seq = np.frombuffer(b"".join(self.seqs[bare]), np.uint64)
        opens = seq == np.frombuffer(_START, np.uint64)[0]
        # what is predicted is what follows the opening two symbols
        said = ~opens
        said[1:] &= ~opens[:-1]
        at = np.flatnonzero(said).astype(np.int32)
        rest, first, power = np.zeros(len(at), np.uint64), SEEDS[bare], 1
        for n in range(1, self.orders[bare] + 1):
            # the key of the n - 1 symbols before; where it isn't asked for, no longer one is
            under = rest + np.uint64(first)
            if self.asked is not None and n > 1:
                keep = np.flatnonzero(among(self.asked, under))
                at, rest, under = at[keep], rest[keep], under[keep]
            t = pa.table([pa.array(under), pa.array(under * np.uint64(MIX) + seq[at])], names=["g", "h"]).group_by(["g", "h"][n == 1 :], use_threads=False).aggregate([("g", "min"), ([], "count_all")])
            c = t["count_all"].to_numpy()
            self.tables.append(pa.table([t["g_min"], t["h"], pa.array(-c if n >= RARE_FROM else c)], names=["g", "h", "c"]))
            if n > 2:
                keep = np.flatnonzero(~opens[at - (n - 1)])
                at, rest = at[keep], rest[keep]
            rest = rest + seq[at - n] * np.uint64(power)
            first, power = first * MIX & BITS, power * MIX & BITS
        self.seqs[bare], self.sizes[bare] = [], 0
        if sum(t.num_rows for t in self.tables) > 2 * HELD_GRAMS:
            self._merge()

    def _merge(self) -> None:
        if len(self.tables) > 1:
            self.tables = [_once(pa.concat_tables(self.tables))]

    def full(self) -> bool:
        return len(self.tables) == 1 and self.tables[0].num_rows > HELD_GRAMS

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(what they follow, keys, counts), each n-gram once; they are counted anew after it."""
        for bare in (False, True):
            self._count(bare)
        self._merge()
        t, self.tables = (self.tables or [pa.table({"g": pa.array([], "uint64"), "h": pa.array([], "uint64"), "c": pa.array([], "int64")})])[0], []
        return tuple(t[c].to_numpy() for c in ("g", "h", "c"))


_START, _S, _DANDA = _bytes(START), _bytes("S"), _bytes("।")


def _fixed(ends: set[int], gaps: dict[int, int]) -> tuple[set[int], set[int]]:
    """Ends that have an event in the lattice, and gaps that are none for certain."""
    return {e for e in ends if gaps.get(e, -1) >= 0}, {e for e, c in gaps.items() if c < 0}


class Splitter:
    """The two models: of texts as they are, and of texts without final marks."""

    def __init__(self, marked: HiddenEventModel, bare: HiddenEventModel):
        self.marked, self.bare = marked, bare

    def split(self, text: str) -> list[tuple[int, int]]:
        """(start, end) of the sentences of a text."""
        found = candidates(text)
        gaps = {end: certain for end, _, certain in found}
        p = self.marked.posteriors(text, gaps) if any(c == 0 for c in gaps.values()) else {}
        ends = {end: nxt for end, nxt, certain in found if certain > 0 or p.get(end, 0.0) >= 0.5}
        for a, b in bare_paragraphs(text):
            part = text[a:b]
            inner = bare_candidates(part)
            if inner:
                q = self.bare.posteriors(part, {end: c for end, _, c in inner})
                ends.update({a + end: a + nxt for end, nxt, _ in inner if q.get(end, 0.0) >= BARE_POSTERIOR})
        out, start = [], len(text) - len(text.lstrip())
        for end in sorted(ends):
            if end <= start:
                continue
            if text[start:end].strip():
                out.append((start, start + len(text[start:end].rstrip())))
            start = ends[end]
        last = len(text.rstrip())
        if last > start:
            out.append((start, last))
        return out


def without_marks(text: str, ends: list[int]) -> tuple[str, list[int]]:
    """The text without the marks that end its sentences, and the ends' new places."""
    out, places, at, size = [], [], 0, 0
    for end in ends:
        core = text[at:end].rstrip(CLOSING)
        piece = core.rstrip(FINALS)
        piece += text[at + len(core) : end]
        out.append(piece)
        size += len(piece)
        places.append(size)
        at = end
        gap = _SPACE.match(text, end).group()
        out.append(gap)
        size += len(gap)
        at += len(gap)
    out.append(text[at:])
    return "".join(out), places


def _examples(texts: list[str], bare: bool):
    """(text, ends, gaps) of the texts labelled by rule, as they are or without their final marks."""
    for text in texts:
        if not text.strip():
            continue
        ends = annotate(text)
        if bare:
            text, ends = without_marks(text, ends)
            held = set(ends)
            yield text, held, {end: 0 if end in held else c for end, _, c in bare_candidates(text)}
        else:
            yield text, set(ends), {end: c for end, _, c in candidates(text)}


#: Code points that the tables of letters go to: below it, texts that _OTHER finds nothing in have all of theirs.
_LETTERS = 0x2E80
#: Bits of what a code point is; the last one stands for all of _OTHER.
_SPACE_BIT, _STOP_BIT, _QUOTE_BIT, _OTHER_BIT, _WORD_BIT = 1, 2, 4, 8, 16
_KINDS = np.array([_SPACE_BIT * chr(c).isspace() | _STOP_BIT * (chr(c) in FINALS) | _QUOTE_BIT * (_QUOTES.match(chr(c)) is not None) | _OTHER_BIT * (c == _LETTERS - 1 or _OTHER.match(chr(c)) is not None) | _WORD_BIT * (c < 128 and chr(c).isalnum()) for c in range(_LETTERS)], np.uint8)
_VALUES = np.array([xxhash.xxh3_64_intdigest(chr(c).translate(ZEROS).encode()) if not 0xD800 <= c < 0xE000 else 0 for c in range(_LETTERS)], np.uint64)


@functools.lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of MIX and of its inverse in 64 bits."""
    return tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)])) for x in (MIX, pow(MIX, -1, 1 << 64)))


class Places:
    """Numbers of the words met last, by the first bits of their letters' sum; digits are alike."""

    def __init__(self):
        self.keys, self.numbers = np.zeros(1 << WORD_BITS, np.uint64), np.zeros(1 << WORD_BITS, np.int64)
        self.keys[0] = BITS  # a key of no word's that has this place

    def numbered(self, joined: str, a: np.ndarray, starts: np.ndarray, ends: np.ndarray, number_of) -> np.ndarray:
        """The numbers of a text's words, given its code points; number_of: gives that of a word not met."""
        # a word's key is the sum of its letters' values times powers by their places in it
        power, inverse = _powers(1 << (len(a) - 1).bit_length())
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[a] * power[: len(a)])])
        keys = (sums[ends] - sums[starts]) * inverse[starts]
        for k in np.flatnonzero(ends - starts >= 64).tolist():
            keys[k] = xxhash.xxh3_64_intdigest(joined[starts[k] : ends[k]].translate(ZEROS).encode())
        place = (keys >> np.uint64(64 - WORD_BITS)).view(np.int64)
        number = self.numbers[place]
        new = np.flatnonzero(self.keys[place] != keys)
        if len(new):
            _, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            at = new[first]
            got = np.array([number_of(joined[s:e]) for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            number[new] = got[back]
            self.keys[place[at]], self.numbers[place[at]] = keys[at], got
        return number


class WordCounts:
    """Counts of pieces of texts without white space; digits are alike."""

    def __init__(self):
        self.single: Counter[str] = Counter()
        self.named: dict[str, int] = {}
        self.counts, self.places = np.zeros(0, np.int64), Places()

    def __len__(self) -> int:
        return len(self.single) + len(self.named)

    def number(self, word: str) -> int:
        return self.named.setdefault(word.translate(ZEROS), len(self.named))

    def add(self, texts: list[str]) -> None:
        block, size = [], 0
        for text in texts:
            if len(text) > BLOCK_LETTERS or _OTHER.search(text):
                self.single.update(text.split())
                continue
            if size + len(text) > BLOCK_LETTERS:
                self._add(block)
                block, size = [], 0
            block.append(text)
            size += len(text) + 1
        self._add(block)

    def _add(self, texts: list[str]) -> None:
        joined = "\n".join(["", *texts, ""])
        a = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        space = _KINDS[a] & _SPACE_BIT
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        counts = np.bincount(self.places.numbered(joined, a, edges[::2], edges[1::2], self.number), minlength=len(self.named))
        counts[: len(self.counts)] += self.counts
        self.counts = counts

    def take(self) -> Counter:
        """The counts; what comes after is counted anew."""
        out = self.single
        out.update(dict(zip(self.named, self.counts.tolist())))
        self.__init__()
        return out


class Shared(dict):
    """Numbers of words by their symbols in both models: words of the same symbols have the same. Digits are alike.

    flat, at, size: the hashes of the symbols of all, and by model where a number's stand.
    """

    def __init__(self, marked: HiddenEventModel, bare: HiddenEventModel):
        super().__init__()
        self.models = marked, bare
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.known: dict[tuple[bytes, bytes], int] = {}
        self.plains: dict[str, tuple[int, bool]] = {}
        self.flat, self.at, self.size = bytearray(), (array("q"), array("q")), (array("q"), array("q"))
        self.places = Places()
        self.held: tuple = (-1, ())

    def __missing__(self, word: str) -> int:
        alike = word.translate(ZEROS)
        if alike != word:
            return self[alike]
        symbols = tuple(b"".join(map(m.pieces[0].symbols.__getitem__, m.pieces[0].tokens(word))) for m in self.models)
        out = self.known.get(symbols)
        if out is None:
            out = self.known[symbols] = len(self.known)
            for k, x in enumerate(symbols):
                self.at[k].append(len(self.flat) // 8)
                self.size[k].append(len(x) // 8)
                self.flat += x
        self[word] = out
        return out

    def plain(self, word: str) -> tuple[int, bool]:
        """The number of a sentence's last word without its marks, and whether a gap may follow it."""
        found = self.plains.get(word)
        if found is None:
            core = word.rstrip(CLOSING)
            plain = core.rstrip(FINALS) + word[len(core) :]
            found = self.plains[word] = self[plain], _may_end(plain[-1])
        return found

    def arrays(self) -> tuple:
        """flat, and (at, size) by model."""
        if self.held[0] != len(self.known):
            self.held = len(self.known), (np.frombuffer(bytes(self.flat), np.uint64), *((np.array(at), np.array(size)) for at, size in zip(self.at, self.size)))
        return self.held[1]


def count_text(text: str, grams: Grams, marked: HiddenEventModel, bare: HiddenEventModel, shared: Shared) -> None:
    """Add the n-grams of a text, labelled by rule, as it is and without its final marks, as train does with _examples."""
    count_texts([text], grams, marked, bare, shared)


def count_texts(texts: list[str], grams: Grams, marked: HiddenEventModel, bare: HiddenEventModel, shared: Shared) -> None:
    """Do so with texts; those of scripts that part words and have case, whose ends stand before white space, by blocks."""
    block, size = [], 0
    for text in texts:
        if len(text) > BLOCK_LETTERS:
            _count_singly(text, candidates(text), grams, marked, bare)
            continue
        if size + len(text) > BLOCK_LETTERS:
            _count_block(block, grams, marked, bare, shared)
            block, size = [], 0
        block.append(text)
        size += len(text) + 1
    if block:
        _count_block(block, grams, marked, bare, shared)


def _count_singly(text: str, found: list[tuple[int, int, int]], grams: Grams, marked: HiddenEventModel, bare: HiddenEventModel) -> None:
    ends = _annotated(text, found)
    other = _OTHER.search(text)
    grams.add(marked, text, *_fixed(set(ends), {e: c for e, _, c in found}))
    text, ends = without_marks(text, ends)
    if other and (_ANY_UNSPACED.search(text) or _THAI.search(text)):
        held = set(ends)
        grams.add(bare, text, *_fixed(held, {e: 0 if e in held else c for e, _, c in bare_candidates(text)}))
        return
    # elsewhere no gap is closed, and only the ends are to be looked at
    events, spans = set(), closed_spans(text)
    for e in ends:
        nxt = _SPACE.match(text, e).end()
        if 0 < e < nxt < len(text) and not any(s < e < f for s, f in spans) and _parts(text[e - 1], text[nxt]):
            events.add(e)
    grams.add(bare, text, events, set())


def _may_end(a: str) -> bool:
    return a.isalnum() or a in CLOSING or unicodedata.category(a)[0] == "M"


def _may_open(b: str) -> bool:
    return b.isalnum() or b in PAIRS


def _parts(a: str, b: str) -> bool:
    """Whether white space between two characters is a gap of a text without marks."""
    return _may_end(a) and _may_open(b)


_ONLY_MARKS = set(FINALS + CLOSING)


def _plain_ends(text: str, found: list[tuple[int, int, int]], ends: list[int]) -> bool:
    """Whether each gap of a text stands before white space, and each sentence ends with a word that isn't marks alone."""
    for end, nxt, _ in found:
        if nxt == end:
            return False
    for end in ends:
        at = end - 1
        while text[at] in _ONLY_MARKS:
            at -= 1
            if at < 0:
                return False
        if text[at].isspace():
            return False
    return True


_GAPS = np.array([int.from_bytes(_bytes(x), sys.byteorder) for x in ("_", "/", "¶", "_-", "/-", "¶-", "S", START)], np.uint64)


def _count_block(texts: list[str], grams: Grams, marked: HiddenEventModel, bare: HiddenEventModel, shared: Shared) -> None:
    """Add texts together.

    The two models differ in the last word of each sentence, in the events and in the gaps that are none for certain; no end lies in a closed span.
    """
    if len(shared) + len(shared.plains) > HELD:
        shared.clear()
    joined = "\n".join(["", *texts, ""])
    a = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), _LETTERS - 1)
    kinds = _KINDS[a]
    bases = np.cumsum([1, *(len(t) + 1 for t in texts)])
    of_text = np.bitwise_or.reduceat(kinds, bases[:-1])
    stop = np.flatnonzero(kinds & _STOP_BIT)
    apart = np.diff(stop) > 1
    opening, closing = stop[np.append(True, apart)[: len(stop)]], stop[np.append(apart, True)[: len(stop)]] + 1
    used = kinds[closing] & _WORD_BIT == 0
    opening, closing = opening[used], closing[used]
    cuts = np.searchsorted(opening, bases).tolist()
    opening, closing = opening.tolist(), closing.tolist()

    # (end, whether it is closed, whether a gap may stand before what follows) of gaps with an event or closed
    marks, kept, bases = [], [], bases.tolist()
    for k, (text, kind) in enumerate(zip(texts, of_text.tolist())):
        if kind & _OTHER_BIT:
            _count_singly(text, candidates(text), grams, marked, bare)
            continue
        base, till = bases[k], bases[k + 1] - 1
        found = candidates(text, [(s - base, e - base) for s, e in zip(opening[cuts[k] : cuts[k + 1]], closing[cuts[k] : cuts[k + 1]]) if e < till], kind & _QUOTE_BIT > 0)
        ends = _annotated(text, found)
        if not _plain_ends(text, found, ends):
            _count_singly(text, found, grams, marked, bare)
            continue
        held = set(ends)
        marks += [(base + end, certain < 0, _may_open(text[nxt])) for end, nxt, certain in found if certain < 0 or end in held]
        kept.append(k)
    if not kept:
        return

    space = kinds & _SPACE_BIT
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if len(kept) < len(texts):
        fit = np.zeros(len(texts), bool)
        fit[kept] = True
        fit = fit[np.searchsorted(bases, starts, "right") - 1]
        starts, ends = starts[fit], ends[fit]
    number = shared.places.numbered(joined, a, starts, ends, shared.__getitem__)

    firsts = np.searchsorted(starts, [bases[k] for k in kept])
    lasts = np.append(firsts[1:], len(starts)) - 1
    gap = (a[ends] == 10).astype(np.int64)
    wide = np.flatnonzero(starts[1:] - ends[:-1] > 1)
    if len(wide):
        lines = np.flatnonzero(a == 10)
        gap[wide] = np.minimum(np.searchsorted(lines, starts[wide + 1]) - np.searchsorted(lines, ends[wide]), 2)
    gap[lasts] = 6

    end, closed, opens = (np.array([m[k] for m in marks], t) for k, t in enumerate((np.int64, bool, bool)))
    at = np.searchsorted(ends, end)
    event = at[~closed]
    ended = np.concatenate([event, lasts])
    plain = [shared.plain(joined[s:e]) for s, e in zip(starts[ended].tolist(), ends[ended].tolist())]
    without = number.copy()
    without[ended] = [n for n, _ in plain]
    flat, of_marked, of_bare = shared.arrays()
    both = np.array([x for _, x in plain[: len(event)]], bool) & opens[~closed]
    for model, number, gaps, event, (of, size) in ((marked, number, gap.copy(), event, of_marked), (bare, without, gap, event[both], of_bare)):
        if model is marked:
            gaps[at[closed]] += 3
        grams.put(model, [_laid(flat, of[number], size[number], gaps, event, firsts).tobytes()])


def _laid(flat: np.ndarray, of: np.ndarray, size: np.ndarray, gaps: np.ndarray, event: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The symbols of words and of the gaps after them, with events after some, and the opening two before the first words of texts."""
    width = size + 1
    width[event] += 1
    width[firsts] += 2
    at = np.cumsum(width)
    out = np.full(at[-1], _GAPS[6])
    at -= width
    out[at[firsts]] = _GAPS[7]
    at[firsts] += 2
    out[at] = flat[of]
    for k in np.flatnonzero(size > 16).tolist():
        out[at[k] : at[k] + size[k]] = flat[of[k] : of[k] + size[k]]
    more, n = np.flatnonzero((size > 1) & (size <= 16)), 1
    while len(more):
        out[at[more] + n] = flat[of[more] + n]
        n += 1
        more = more[size[more] > n]
    out[at + size] = _GAPS[gaps]
    return out


def _count_words(counts: Counter, bare: bool) -> Counter:
    """Words of pieces without white space, with their counts."""
    seen: Counter[str] = Counter()
    find = (_BARE_TOKEN if bare else _TOKEN).findall
    for piece, n in counts.items():
        if piece.isalpha() and not (bare and _ANY_UNSPACED.search(piece)):
            seen[piece] += n
            continue
        for t in find(piece):
            if t[0].isalpha():
                seen[t] += n
    return seen


def train_model(texts: list[str]) -> Splitter:
    """The models of texts labelled by rule. Their words are those that occur WORD_LEAST times in them."""
    models = []
    for bare in (False, True):
        seen = _count_words(Counter(p for text in texts for p in text.split()), bare)
        model = HiddenEventModel({w for w, n in seen.items() if n >= WORD_LEAST} | ABBREVIATIONS, BARE_ORDER if bare else ORDER, bare)
        model.train(_examples(texts, bare))
        models.append(model)
    return Splitter(*models)


def _models(words: dict[bool, np.ndarray], kind: type = HiddenEventModel) -> tuple[HiddenEventModel, HiddenEventModel]:
    return tuple(kind(Words(words[bare], bare), BARE_ORDER if bare else ORDER, bare) for bare in (False, True))


#: The words that a worker counted with last, and its models of them: the words that they have read serve its next task.
_KEPT: list = [None, ()]


def _kept_models(words: dict[bool, np.ndarray]) -> tuple[HiddenEventModel, HiddenEventModel, Shared]:
    if _KEPT[0] is not words:
        models = _models(words)
        _KEPT[:] = words, (*models, Shared(*models))
    return _KEPT[1]


def known_words(texts: DataFrame) -> dict[bool, np.ndarray]:
    """Hashes of the words that occur WORD_LEAST times in all texts, in order, by model; of them alone the driver gets 8 bytes each."""

    def run(batches):
        held = WordCounts()
        for b in batches:
            held.add(b.column(0).to_pylist())
            if len(held) > HELD_WORDS:
                yield from out(held.take())
        yield from out(held.take())

    def out(held):
        marked = _count_words(held, False)
        # the models read words alike where each script parts them
        unspaced = {p: n for p, n in held.items() if _ANY_UNSPACED.search(p)}
        both = marked.copy()
        both.subtract(_count_words(unspaced, False))
        both.update(_count_words(unspaced, True))
        for bare, seen in ((False, marked), (True, +both)):
            yield pa.RecordBatch.from_arrays([pa.array([bare] * len(seen), pa.bool_()), pa.array([Words.hash(w, bare) for w in seen], pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["bare", "word", "n"])

    found = texts.mapInArrow(run, "bare boolean, word bigint, n bigint").groupBy("bare", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= WORD_LEAST).select("bare", "word").toArrow()
    of, words = found.column(0).to_numpy(), found.column(1).to_numpy()
    return {bare: np.sort(words[of == bare]) for bare in (False, True)}


def asked_filter(rows: DataFrame) -> np.ndarray:
    """The filter of what the n-grams that rows ask for follow: a bit by the key, of FILTER_BITS bits at most."""
    n = rows.agg(F.sum(F.size("keys"))).first()[0] or 0
    bits = min(max((4 * n).bit_length(), 16), FILTER_BITS)

    def run(batches):
        held = np.zeros(1 << bits - 6, np.uint64)
        for b in batches:
            # the keys come in twos, an n-gram's and that of what follows
            at = places(b.column(0).flatten().to_numpy()[1::2].view(np.uint64) ^ np.uint64(TOTAL), bits)
            np.bitwise_or.at(held, (at >> np.uint64(6)).view(np.int64), np.uint64(1) << (at & np.uint64(63)))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at].view(np.int64))], names=["at", "held"])

    found = rows.select("keys").mapInArrow(run, "at bigint, held bigint").groupBy("at").agg(F.bit_or("held").alias("held")).toArrow()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return out.view(np.uint8)


def gram_facts(texts: DataFrame, words, asked) -> DataFrame:
    """(key, a, b) of HiddenEventModel.facts, counted over all texts, of what was asked for and few others; words, asked: the
    broadcast hashes of the words known and filter."""

    def run(batches):
        models, grams = _kept_models(words.value), Grams(asked.value)
        for b in batches:
            texts = list(filter(str.strip, b.column(0).to_pylist()))
            for k in range(0, len(texts), BLOCK_ROWS):
                count_texts(texts[k : k + BLOCK_ROWS], grams, *models)
                if grams.full():
                    yield out(grams)
        yield out(grams)

    def out(grams):
        g, h, c = grams.take()
        return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(h.view(np.int64)), pa.array(c)], names=["g", "h", "c"])

    grams = texts.mapInArrow(run, "g bigint, h bigint, c bigint").repartition("g").groupBy("g", "h").agg(F.sum("c").alias("c"))
    grams = cut(grams, "grams")
    used = (F.col("a") > 1) | ~F.col("long")
    counts = grams.select(F.col("h").alias("key"), F.abs("c").alias("a"), F.lit(0).cast("bigint").alias("b"), (F.col("c") < 0).alias("long"))
    totals = grams.groupBy(F.col("g").bitwiseXOR(F.lit(TOTAL)).alias("key")).agg(F.sum(F.abs("c")).alias("a"), F.count("*").alias("b"), (F.min("c") < 0).alias("long"))
    return counts.unionByName(totals).where(used).drop("long")


_UNITS = T.StructType([T.StructField("id", T.StringType()), T.StructField("sentence_no", T.IntegerType()), T.StructField("start_pos", T.IntegerType()), T.StructField("end_pos", T.IntegerType()), T.StructField("text", T.StringType())])


def split_sentences(df: DataFrame, id_col: str = "id", text_col: str = "text", examples: DataFrame | None = None) -> DataFrame:
    """(id, sentence_no, start_pos, end_pos, text) of every sentence of every row, in reading order.

    examples: (id, text), the rows that the models are trained on, all of them; without them, df itself. Their counts are
    joined to the rows by blocks of BLOCK_ROWS, each with those that its stretches may ask for.
    """
    spark = df.sparkSession
    src = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())
    texts = (src if examples is None else examples).select("text").where(F.trim("text") != "")
    words = spark.sparkContext.broadcast(known_words(texts))

    def ask(batches):
        part, count, models, splitter = TaskContext.get().partitionId(), 0, (), None
        for b in batches:
            keys = []
            for t in b.column(1).to_pylist():
                if count % BLOCK_ROWS == 0:
                    models = _models(words.value, Asking)
                    splitter = Splitter(*models)
                count += 1
                splitter.split(t)
                keys.append([_signed(k) for m in models for k in m.new])
                for m in models:
                    m.new = []
            at = count - b.num_rows
            blocks = pa.array([(part << 32) + (at + k) // BLOCK_ROWS for k in range(b.num_rows)], pa.int64())
            yield pa.RecordBatch.from_arrays([blocks, b.column(0), b.column(1), pa.array(keys, pa.list_(pa.int64()))], names=["block", "id", "text", "keys"])

    def run(rows, facts):
        held = dict(zip(facts["key"].to_numpy().view(np.uint64).tolist(), zip(facts["a"].to_pylist(), facts["b"].to_pylist())))
        models = _models(words.value)
        for m in models:
            m.facts = held
        splitter = Splitter(*models)
        found = [(i, n, s, e, t[s:e]) for i, t in zip(rows["id"].to_pylist(), rows["text"].to_pylist()) for n, (s, e) in enumerate(splitter.split(t))]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*found) if found else [()] * 5, (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()))], names=_UNITS.names)

    rows = cut(src.mapInArrow(ask, "block bigint, id string, text string, keys array<bigint>"), "asked")
    asked = spark.sparkContext.broadcast(asked_filter(rows))
    facts = rows.select("block", F.explode("keys").alias("key")).join(gram_facts(texts, words, asked), "key").select(F.col("block").alias("of"), "key", "a", "b")
    return rows.select("block", "id", "text").groupBy("block").cogroup(facts.groupBy("of")).applyInArrow(run, _UNITS)
