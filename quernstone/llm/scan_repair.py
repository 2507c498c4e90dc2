"""Problem 5: repair of text from scanned pages.

A hidden Markov model over the lines of a chunk has the states head (running lines and page numbers above), body, break (a
body line whose last word goes on in the next) and foot. What is observed of a line is whether it is a page number or recurs
at the same edge of the document's pages, how far word counts speak for its last word going on in the next line, and its layout:
its length against the chunk's other lines, capitals, indent, an empty line before it. Transitions and emissions are
re-estimated by expectation maximisation on all chunks; the best state sequence labels the lines, head being open to the first
chunk of a page and foot to the last. Misread words are those for which the corpus has a far more frequent word that
recognition would confuse with them, found by a form that all confused characters share, and exact counts.

Defined results: null and blank texts have no faults; chunks without document or page have no running lines or page numbers;
blank lines are no lines of the model; repeated chunks are judged each. In a document without page numbers, pages of the same
text are one page where recurring lines are counted.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.runtime import cut

#: Lines from the top and the bottom of a page among which a running line may change its place; further in it keeps it. Pages
#: on which one stands at least.
TOP, BOTTOM, MIN_PAGES = 2, 3, 3
#: Rounds of re-estimation, and lines whose states are summed over at once.
ROUNDS, BLOCK_LINES = 3, 100_000
#: A corrected word must occur so often, and so many times more often than the word as it stands.
WORD_LEAST, WORD_RATIO = 4, 8
#: Different pieces of text that a task holds before it passes the counts of their words on.
HELD_WORDS = 1_000_000

# Characters that recognition confuses with letters, each with what it may stand for.
CONFUSED = {"¢": "c", "†": "t", "#": "h", "0": "oо", "¡": "i", "|": "il", "@": "a", "1": "li", "§": "s", "µ": "u", "ñ": "n", "å": "a", "ë": "e", "ö": "o", "ø": "o", "$": "s", "€": "e", "£": "e", "¥": "y", "5": "s", "8": "b"}
SPLIT_MARKS = "-‐‑¬­"

HEAD, BODY, BREAK, FOOT = range(4)
#: What is seen of a line at the edge; the evidence that its last word goes on; its layout is one of LAYOUTS.
PLAIN, NUMBER, RECURRING = range(3)
NO_SPLIT, WEAK_SPLIT, SPLIT = range(3)
LAYOUTS = 24

_PAGE_NO = re.compile(r"^\W*(?:(?:trang|page|pag|seite|стр|tr|pg|p)\b\W{0,2})?\d{1,4}(?:\s*[/|]\s*\d{1,4})?(?:\s*(?:頁|页|ページ))?[^\w.,;:)%]*$", re.I)
_EDGE_NUMBER = re.compile(r"^\s*\d{1,4}\s{2,}|^\s*\d{1,4}\s*[|–—-]\s+|\s{2,}\d{1,4}\s*$|\s+[|–—-]\s*\d{1,4}\s*$|\s\d{1,4}\s*$")
_SPLIT_END = re.compile(rf"([^\W\d_]+)([{SPLIT_MARKS}])\s*$")
_COMPOUND = re.compile(r"(?<![\w-])([^\W\d_]+)[-‐‑]([^\W\d_]+)(?![\w-])")
_WORD = re.compile(r"[^\W\d_]+")
_CONFUSED_CLASS = "".join(re.escape(c) for c in CONFUSED)
_SUSPECT_MARK = re.compile(f"[{re.escape(''.join(c for c in CONFUSED if not c.isdigit()))}]")
_SUSPECT_DIGIT = re.compile(r"[0158](?:(?=[^\W\d_])|(?<=[^\W\d_].))")
_TOKEN = re.compile(rf"[^\W\d_{_CONFUSED_CLASS}]*(?:[{_CONFUSED_CLASS}][^\W\d_{_CONFUSED_CLASS}]*)+")
_EDGE_LETTERS = re.compile(rf"^(?:[^\W_]|[{_CONFUSED_CLASS}])+")


@functools.cache
def _forms(letter: str) -> str:
    """A vowel with every accent it may bear."""
    if letter not in "aeo":
        return letter
    return "".join(c for c in map(chr, (*range(0xE0, 0x200), *range(0x1EA0, 0x1EFA))) if c.islower() and unicodedata.normalize("NFD", c)[0] == letter and c not in "åëöøäãõ") + letter


@functools.cache
def _options(c: str) -> str:
    return "".join(_forms(x) if not c.isascii() and unicodedata.normalize("NFD", c)[0] in "aeo" or c in "øåëö" else x for x in CONFUSED[c]) if c in CONFUSED else c


def suspect(text: str) -> bool:
    """Whether a confused character stands anywhere in the text, or a digit beside a letter."""
    return bool(_SUSPECT_MARK.search(text) or _SUSPECT_DIGIT.search(text))


@functools.cache
def _fold_tables() -> tuple[str, str]:
    """Characters and what they fold to: all that may be confused with each other become one, vowels lose their accents."""
    to = {}
    for mark, letters in CONFUSED.items():
        base = {"l": "i", "о": "o"}.get(letters[0], letters[0])
        to[mark] = base
    to["l"] = "i"
    for v in "aeo":
        to.update({x: v for x in _forms(v) if x != v})
    to["о"] = "o"
    return "".join(to), "".join(to.values())


def folded(word: Column) -> Column:
    return F.translate(word, *_fold_tables())


def stands_for(token: str, word: str) -> bool:
    """Whether recognition may have made token of word: character by character, and not the same."""
    return len(token) == len(word) and token != word and all(x == y or y in _options(x) for x, y in zip(token, word))


def _may_be_word(low: str) -> bool:
    return len(low) > 1 and any(c.isalpha() and c not in CONFUSED for c in low)


def splits(line: str, following: str) -> tuple[str, str, str] | None:
    """(part, mark, rest) if the line ends in a part of a word and a mark, and the following line begins with letters."""
    bare = line.rstrip()
    if bare[-1:] not in SPLIT_MARKS or not bare or not (m := _SPLIT_END.search(bare, max(0, len(bare) - 60))):
        return None
    rest = _EDGE_LETTERS.match(following.lstrip())
    if not rest or not any(c.isalpha() for c in rest.group()):
        return None
    return m.group(1), m.group(2), rest.group()


def edge_line(line: str, form: str) -> tuple[int, int]:
    """(flag, key) of a line and its folded form; flag: 2 for a page number, 1 for a line with one, else 0. The key is what a running
    line has in common on all pages, however it is recognised: it lacks the page number at its start or end, and is folded."""
    bare = line.strip()
    flag = 2 if len(bare) < 24 and _PAGE_NO.match(bare) else 1 if (bare[0].isdigit() or bare[-1].isdigit()) and _EDGE_NUMBER.search(line) else 0
    if flag and (number := _EDGE_NUMBER.search(line)):
        form = form[: number.start()] + form[number.end() :]
    return flag, _hash(" ".join(form.split()))


@functools.cache
def _fold_table() -> np.ndarray:
    """Code point -> what it folds to."""
    table = np.arange(0x110000, dtype=np.uint32)
    for x, y in zip(*_fold_tables()):
        table[ord(x)] = ord(y)
    return table


def folded_text(text: str) -> str:
    """The text with every character folded to another, so that its lines and places stay."""
    return _fold_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].tobytes().decode("utf-32-le", "surrogatepass")


def _hash(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


def layouts(lines: list[str], held: list[int]) -> list[int]:
    """The layout of the lines that aren't blank: length in thirds of the longest, capitals, indent, an empty line before."""
    longest = max(len(lines[n].strip()) for n in held)
    out = []
    for k, n in enumerate(held):
        x = lines[n]
        size = len(x.strip())
        out.append(min(2, 3 * size // (longest + 1)) * 8 + (x.upper() == x and x.lower() != x) * 4 + (x[:1].isspace()) * 2 + (k > 0 and held[k - 1] < n - 1))
    return out


_INTS, _LONGS = T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType())
_SEEN = T.StructType(
    [T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("chunk_id", T.StringType()), T.StructField("content", T.LongType())]
    + [T.StructField("line_nos", _INTS), T.StructField("layout", _INTS), T.StructField("flags", _INTS), T.StructField("keys", _LONGS)]
    + [T.StructField("line_no", T.IntegerType()), T.StructField("token", T.StringType()), T.StructField("part", T.StringType()), T.StructField("mark", T.StringType()), T.StructField("rest", T.StringType())]
)
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64())}


def _batch(n_rows: int, /, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[f.name], _KINDS[f.dataType.simpleString()]) if f.name in columns else pa.nulls(n_rows, _KINDS[f.dataType.simpleString()]) for f in _SEEN.fields]
    return pa.RecordBatch.from_arrays(arrays, names=_SEEN.names)


def word_counts(pieces: Counter) -> Counter:
    """Counts of the words in lower case, and of the hyphenated compounds, of pieces of text without white space, with theirs."""
    counts: Counter[str] = Counter()
    for piece, n in pieces.items():
        low = piece.lower()
        if low.isalpha():
            counts[low] += n
            continue
        for w in _WORD.findall(low):
            counts[w] += n
        if "-" in low or "‐" in low or "‑" in low:
            for x, y in _COMPOUND.findall(low):
                counts[f"{x}-{y}"] += n
    return counts


def observe(batches):
    """Of batches (chunk_id, text): counts of words and of hyphenated compounds inside lines; each chunk's lines; and its words
    with confused characters and words that may be split."""
    pieces: Counter[str] = Counter()

    def counted():
        counts = word_counts(pieces)
        words = list(counts)
        for a in range(0, len(words), 100_000):
            part = words[a : a + 100_000]
            yield _batch(len(part), word=part, n=[counts[w] for w in part])
        pieces.clear()

    for b in batches:
        pages: dict[str, list] = {c: [] for c in ("chunk_id", "content", "line_nos", "layout", "flags", "keys")}
        doubts: dict[str, list] = {c: [] for c in ("chunk_id", "line_no", "token", "part", "mark", "rest")}
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            parts = t.split()
            pieces.update(parts)
            lines = t.split("\n")
            held = [n for n, x in enumerate(lines) if x and not x.isspace()]
            if not held:
                continue
            forms = folded_text(t).split("\n")
            edges = [edge_line(lines[n], forms[n]) for n in held]
            for c, v in zip(pages, (i, _hash(" ".join(parts)), held, layouts(lines, held), [f for f, _ in edges], [k for _, k in edges])):
                pages[c].append(v)
            found: list[tuple] = []
            if any(m in t for m in SPLIT_MARKS):
                found += [(n, (s[0] + s[2]).lower(), *s) for n, line in enumerate(lines[:-1]) if (s := splits(line, lines[n + 1]))]
            if suspect(t):
                found += [(n, m.group().lower(), None, None, None) for n, line in enumerate(lines) if suspect(line) for m in _TOKEN.finditer(line) if _may_be_word(m.group().lower())]
            for x in found:
                for c, v in zip(doubts, (i, *x)):
                    doubts[c].append(v)
        if pages["chunk_id"]:
            yield _batch(len(pages["chunk_id"]), **pages)
        if doubts["chunk_id"]:
            yield _batch(len(doubts["chunk_id"]), **doubts)
        if len(pieces) > HELD_WORDS:
            yield from counted()
    yield from counted()


def corrections(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(token, correct, n): the most frequent word that each token may stand for, often enough; words: (word, n)."""

    @F.pandas_udf("boolean")
    def fits(token, word):  # noqa: ANN001, ANN202
        return token.combine(word, stands_for)

    marks = "".join(re.escape(c) for c in CONFUSED)
    asked = tokens.select("token").where(F.col("token").rlike(f"[{marks}]")).distinct()
    own = asked.join(words.select(F.col("word").alias("token"), F.col("n").alias("own")), "token", "left").withColumn("own", F.coalesce("own", F.lit(0))).withColumn("form", folded(F.col("token")))
    known = words.where(F.col("n") >= WORD_LEAST).select("word", "n", folded(F.col("word")).alias("form"))
    pairs = own.join(known, "form").where((F.col("n") >= WORD_RATIO * F.col("own")) & (F.length("token") == F.length("word"))).where(fits("token", "word"))
    return pairs.groupBy("token").agg(F.max_by(F.struct("word", "n"), F.struct("n", "word")).alias("best")).select("token", F.col("best.word").alias("correct"), F.col("best.n").alias("n"))


def judged(seen: DataFrame) -> DataFrame:
    """(chunk_id, line_no, token, part, mark, rest, correct, split) of all doubtful words; split: the evidence, null for no split."""
    words = cut(seen.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "words")
    doubts = seen.where("token is not null").select("chunk_id", "line_no", "token", "part", "mark", "rest", F.lower(F.concat_ws("-", "part", "rest")).alias("compound"))
    fixed = cut(corrections(doubts, words), "corrections")
    pieces = doubts.where("part is not null").select(F.col("token").alias("asked")).union(doubts.where("part is not null").select("compound")).distinct()
    counted = cut(pieces.join(words, F.col("asked") == F.col("word")).select("asked", "n"), "counted")
    joined = doubts.join(fixed.select("token", "correct", F.col("n").alias("n_correct")), "token", "left")
    joined = joined.join(counted.select(F.col("asked").alias("token"), F.col("n").alias("n_joined")), "token", "left").join(counted.select(F.col("asked").alias("compound"), F.col("n").alias("n_compound")), "compound", "left")
    whole, compound = F.coalesce("n_joined", F.lit(0)), F.coalesce("n_compound", F.lit(0))
    whole = F.when((whole < 2) & F.col("correct").isNotNull(), F.col("n_correct")).otherwise(whole)
    small = F.col("part").rlike(r"\p{Ll}$") & (F.lower("rest") == F.col("rest"))
    evidence = (
        F.when(F.col("part").isNull(), None)
        .when(F.col("mark").isin("¬", "\u00ad"), F.when((whole > 0) | (compound == 0), SPLIT).otherwise(NO_SPLIT))
        .when((whole >= 2) & (whole > 2 * compound), SPLIT)
        .when((compound == 0) & (whole == 0) & small & (F.col("mark") == "‐"), WEAK_SPLIT)
        .otherwise(NO_SPLIT)
    )
    return joined.select("chunk_id", "line_no", "token", "part", "mark", "rest", "correct", evidence.alias("split"))


#: The share of lines that each state labels, about.
SHARES = np.array([0.03, 0.87, 0.07, 0.03])
#: Lines that the prior counts for at least.
PRIOR_LINES = 20_000


class LineModel:
    """The hidden Markov model of a chunk's lines. Observed: (edge, split, layout) of each."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.start, self.move, self.emit = start, move, emit

    @staticmethod
    def prior() -> LineModel:
        start = np.array([0.1, 0.85, 0.04, 0.01])
        move = np.array([[0.3, 0.65, 0.04, 0.01], [0.0001, 0.91, 0.06, 0.03], [0.0001, 0.93, 0.06, 0.01], [0.0001, 0.0001, 0.0001, 0.9997]])
        edge = np.array([[0.004, 0.2, 0.796], [0.986, 0.01, 0.004], [0.997, 0.001, 0.002], [0.02, 0.5, 0.48]])
        split = np.array([[0.987, 0.003, 0.01], [0.987, 0.003, 0.01], [0.002, 0.1, 0.898], [0.987, 0.003, 0.01]])
        return LineModel(start, move, (edge, split, np.full((4, LAYOUTS), 1 / LAYOUTS)))

    def seen(self, symbols: np.ndarray, first: bool, last: bool) -> np.ndarray:
        """(lines, states) likelihoods; head is open to the first chunk of a page only, foot to the last."""
        out = self.emit[0][:, symbols[:, 0]] * self.emit[1][:, symbols[:, 1]] * self.emit[2][:, symbols[:, 2]]
        closed = [s for s, is_open in ((HEAD, first), (FOOT, last)) if not is_open]
        out[closed] *= 1e-12
        return out.T

    def expected(self, sequences: list[tuple[np.ndarray, bool, bool]]) -> np.ndarray:
        """Of sequences, one after the other: their lines, then how often each state starts, follows each and emits each symbol."""
        lines, start, move, emit = 0, np.zeros(4), np.zeros((4, 4)), [np.zeros(e.shape) for e in self.emit]
        order, at = sorted(range(len(sequences)), key=lambda i: -len(sequences[i][0])), 0
        while at < len(order):
            longest = len(sequences[order[at]][0])
            block = [sequences[i] for i in order[at : at + max(1, BLOCK_LINES // max(1, longest))]]
            at += len(block)
            sizes = np.array([len(x) for x, _, _ in block])
            held = np.arange(longest) < sizes[:, None]
            like = np.ones((len(block), longest, 4))
            like[held] = np.concatenate([self.seen(x, first, last) for x, first, last in block])
            # the longest come first: at each place, those that reach it
            reach = held.sum(axis=0)
            a, b = np.zeros(like.shape), np.ones(like.shape)
            a[:, 0] = self.start * like[:, 0]
            a[:, 0] /= a[:, 0].sum(axis=1, keepdims=True)
            for i in range(1, longest):
                k = reach[i]
                a[:k, i] = (a[:k, i - 1] @ self.move) * like[:k, i]
                a[:k, i] /= a[:k, i].sum(axis=1, keepdims=True)
            for i in range(longest - 2, -1, -1):
                k = reach[i + 1]
                ahead = like[:k, i + 1] * b[:k, i + 1]
                b[:k, i] = ahead @ self.move.T
                b[:k, i] /= b[:k, i].sum(axis=1, keepdims=True)
                x = a[:k, i, :, None] * self.move * ahead[:, None, :]
                move += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            g = a * b
            g /= np.where(held, g.sum(axis=2), 1)[:, :, None]
            start += g[:, 0].sum(axis=0)
            of = g[held]
            for e, column in zip(emit, np.concatenate([x for x, _, _ in block]).T):
                for state in range(4):
                    e[state] += np.bincount(column, of[:, state], e.shape[1])
            lines += int(sizes.sum())
        return np.concatenate([[lines], start, move.ravel(), *(e.ravel() for e in emit)])

    def updated(self, sums: np.ndarray, prior: LineModel, weight: float = 20.0) -> LineModel:
        """The model of summed expectations, with a prior of `weight` times as many lines, and PRIOR_LINES more."""
        # each state's prior counts for as many lines as the state is expected to label
        strength = (PRIOR_LINES + weight * sums[0]) * SHARES[:, None]
        parts = np.split(sums[1:], np.cumsum([4, 16, *(e.size for e in self.emit)])[:-1])
        start, move = prior.start * strength.sum() + parts[0], prior.move * strength + parts[1].reshape(4, 4)
        emit = [e * strength + x.reshape(e.shape) for e, x in zip(prior.emit, parts[2:])]
        return LineModel(start / start.sum(), move / move.sum(axis=1, keepdims=True), tuple(e / e.sum(axis=1, keepdims=True) for e in emit))

    def fitted(self, sequences: list[tuple[np.ndarray, bool, bool]], rounds: int = ROUNDS, weight: float = 20.0) -> LineModel:
        """Re-estimated on the sequences, with this model as the prior."""
        model = self
        for _ in range(rounds):
            model = model.updated(model.expected(sequences), self, weight)
        return model

    def fitted_on(self, coded: DataFrame) -> LineModel:
        """As fitted, on all sequences of a table (codes, is_first, is_last); a task returns its sums alone."""
        model = self
        for _ in range(ROUNDS):

            def run(batches, model=model):
                for b in batches:
                    if b.num_rows:
                        yield pa.RecordBatch.from_arrays([pa.array([model.expected(_sequences(b)).tolist()], pa.list_(pa.float64()))], names=["sums"])

            each = F.posexplode("sums").alias("at", "x")
            sums = coded.select("codes", "is_first", "is_last").mapInArrow(run, "sums array<double>").select(each).groupBy("at").agg(F.sum("x").alias("x")).orderBy("at").toArrow().column(1).to_numpy()  # a number a parameter
            if len(sums):
                # to so many places the sums don't depend on their order
                model = model.updated(np.round(sums, 6), self)
        return model

    def labels(self, symbols: np.ndarray, first: bool = True, last: bool = True) -> list[int]:
        """The best state of each line."""
        like, move = np.log(self.seen(symbols, first, last)), np.log(self.move)
        score = np.log(self.start) + like[0]
        back = []
        for i in range(1, len(like)):
            step = score[:, None] + move
            back.append(step.argmax(axis=0))
            score = step.max(axis=0) + like[i]
        states = [int(score.argmax())]
        for b in reversed(back):
            states.append(int(b[states[-1]]))
        return states[::-1]


def recurring_lines(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((chunk_id, is_first, is_last) of the chunks at the edges of pages, (chunk_id, line_no) of the lines that recur there).

    pages: (chunk_id, content, line_nos, flags, keys, document_id, page, off).
    """
    rows = pages.where("document_id is not null and page is not null")
    place = F.struct(F.col("off").isNull(), "off", "chunk_id")
    ends = rows.groupBy("document_id", "page").agg(F.min(place).alias("a"), F.max(place).alias("z")).select("document_id", "page", F.col("a.chunk_id").alias("first_id"), F.col("z.chunk_id").alias("last_id"))
    edges = cut(rows.join(ends, ["document_id", "page"]).where("chunk_id = first_id or chunk_id = last_id").withColumn("is_first", F.col("chunk_id") == F.col("first_id")).withColumn("is_last", F.col("chunk_id") == F.col("last_id")).drop("first_id", "last_id"), "edges")
    each = edges.select("document_id", "page", "chunk_id", "content", "is_first", "is_last", F.size("keys").alias("size"), F.posexplode(F.arrays_zip(F.col("line_nos").alias("line_no"), F.col("flags").alias("flag"), F.col("keys").alias("key"))).alias("at", "line"))
    top, bottom = F.when(F.col("at") < TOP, 0).otherwise(F.col("at")), F.when(F.col("size") - F.col("at") <= BOTTOM, -1).otherwise(F.col("at") - F.col("size"))
    depths = F.array_compact(F.array(F.when(F.col("is_first"), top), F.when(F.col("is_last"), bottom)))
    lines = each.select("document_id", "page", "chunk_id", "content", "line.line_no", "line.flag", "line.key", F.explode(depths).alias("depth"))
    # near the edges top and bottom are one place; further in, only the same depth is
    lines = lines.withColumn("depth", F.when(F.col("depth").isin(0, -1), 0).otherwise(F.col("depth")))
    by = ["document_id", "key", "depth"]
    by_page = lines.groupBy(*by, "page").agg(F.max(F.col("flag") > 0).alias("numbered"), F.min("content").alias("content"))
    # pages of the same text are copies, in which a line recurs with the rest: without page numbers they count once
    contents = by_page.groupBy(*by, "content").agg(F.count("*").alias("n"))
    recurring = contents.groupBy(*by).agg(F.sum("n").alias("n_pages"), F.count("*").alias("n_contents")).where(F.col("n_pages") >= MIN_PAGES).select(*by, "n_pages", (F.col("n_contents") >= MIN_PAGES).alias("recurs"))
    scanned = by_page.where("numbered and depth = 0").select("document_id", "page").distinct().groupBy("document_id").agg(F.count("*").alias("n")).where("n >= 2").select("document_id", F.lit(True).alias("scanned"))
    # further in, a running line stands on at least half of the pages: by chance one recurs at a depth in a long document
    sizes = edges.groupBy("document_id").agg(F.countDistinct("page").alias("pages"))
    recurring = recurring.join(sizes, "document_id").where((F.col("depth") == 0) | (2 * F.col("n_pages") >= F.col("pages"))).drop("n_pages", "pages")
    found = lines.join(recurring, by).join(scanned, "document_id", "left").where(F.col("recurs") | F.col("scanned")).select("chunk_id", "line_no").distinct()
    return edges.select("chunk_id", "is_first", "is_last"), found


def scan_tables(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((chunk_id, line_no, fault) of all faults, the doubtful words of `judged`)."""
    seen = cut(chunks.select(F.col("id").cast("string"), "text").where(F.col("text").isNotNull()).mapInArrow(observe, _SEEN), "seen")
    places = chunks.select(F.col("id").cast("string").alias("chunk_id"), "document_id", "page", F.col("offset").alias("off"))
    lines = seen.where("line_nos is not null").select("chunk_id", "content", "line_nos", "layout", "flags", "keys")
    doubts = cut(judged(seen), "judged")
    edges, recurring = recurring_lines(lines.drop("layout").join(places, "chunk_id"))
    marked = recurring.withColumn("split", F.lit(None).cast("int")).unionByName(doubts.where("split > 0").select("chunk_id", "line_no", "split"))
    by_chunk = marked.groupBy("chunk_id").agg(F.collect_set(F.when(F.col("split").isNull(), F.col("line_no"))).alias("again"), F.collect_set(F.when(F.col("split").isNotNull(), F.struct("line_no", "split"))).alias("splits"))  # lines of one chunk
    numbered = F.exists("flags", lambda f: f == 2)
    sequences = lines.select("chunk_id", "line_nos", "layout", "flags").join(by_chunk, "chunk_id", "left").join(edges, "chunk_id", "left").where(F.col("again").isNotNull() | (F.col("is_first").isNotNull() & numbered))
    held = cut(sequences, "sequences")
    coded = cut(held.mapInArrow(_coded, "chunk_id string, line_nos array<int>, codes array<int>, is_first boolean, is_last boolean"), "coded")
    model = LineModel.prior().fitted_on(coded)

    def run(batches):
        for b in batches:
            out: list[list] = [[], [], []]
            for chunk, nos, (symbols, first, last) in zip(b.column("chunk_id").to_pylist(), b.column("line_nos").to_pylist(), _sequences(b)):
                for n, (edge, split, _), state in zip(nos, symbols.tolist(), model.labels(symbols, first, last)):
                    fault = {NUMBER: "page_no", RECURRING: "running"}.get(edge) if state in (HEAD, FOOT) else "break" if state == BREAK and split else None
                    if fault:
                        for o, v in zip(out, (chunk, n, fault)):
                            o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.string())], names=["chunk_id", "line_no", "fault"])

    labelled = cut(coded.mapInArrow(run, "chunk_id string, line_no int, fault string"), "labelled")
    words = doubts.where("part is null and correct is not null").select("chunk_id", "line_no")
    pieces = doubts.where("part is not null and split > 0 and correct is not null").select("chunk_id", F.explode(F.array(F.struct("line_no", F.col("part").alias("piece")), F.struct((F.col("line_no") + 1).alias("line_no"), F.col("rest").alias("piece")))).alias("x")).select("chunk_id", "x.*")
    odd = pieces.where(F.col("piece").rlike(f"[{''.join(re.escape(c) for c in CONFUSED)}]")).select("chunk_id", "line_no")
    misread = words.unionByName(odd).withColumn("fault", F.lit("misread"))
    return labelled.unionByName(misread).distinct(), doubts


def _symbols(r: dict) -> np.ndarray:
    """(lines, 3) observed symbols of a row of sequences."""
    again, splits_of = set(r["again"] or ()), {x["line_no"]: x["split"] for x in r["splits"] or ()}
    at_edge = r["is_first"] is not None
    return np.array([(NUMBER if at_edge and f == 2 else RECURRING if n in again else PLAIN, splits_of.get(n, NO_SPLIT), layout) for n, layout, f in zip(r["line_nos"], r["layout"], r["flags"])], np.int64)


def _coded(batches):
    """Of batches of sequences, each line's symbols as one number."""
    for b in batches:
        rows = b.to_pylist()
        codes = [(((s := _symbols(r))[:, 0] * 3 + s[:, 1]) * LAYOUTS + s[:, 2]).astype(np.int32) for r in rows]
        yield pa.RecordBatch.from_arrays([b.column("chunk_id"), b.column("line_nos"), pa.array(codes, pa.list_(pa.int32())), *(pa.array([bool(r[c]) for r in rows], pa.bool_()) for c in ("is_first", "is_last"))], names=["chunk_id", "line_nos", "codes", "is_first", "is_last"])


def _sequences(b: pa.RecordBatch) -> list[tuple[np.ndarray, bool, bool]]:
    """(symbols, first, last) of each row of codes."""
    codes = b.column("codes")
    flat, ends = codes.flatten().to_numpy(), codes.offsets.to_numpy()
    symbols = np.stack([flat // (3 * LAYOUTS), flat // LAYOUTS % 3, flat % LAYOUTS], axis=1)
    return [(symbols[x - ends[0] : y - ends[0]], first, last) for x, y, first, last in zip(ends, ends[1:], b.column("is_first").to_pylist(), b.column("is_last").to_pylist())]


def scan_faults(chunks: DataFrame) -> DataFrame:
    """(chunk_id, line_no, fault) of all faults of all chunks."""
    return scan_tables(chunks)[0]


def repaired(text: str, gone: set[int], broken: set[int], correct: dict[int, dict[str, str]]) -> str:
    """The text without the lines gone, the words at the ends of broken lines joined, misread words corrected, and lines run on
    in paragraphs; correct: of each line, words in lower case and what they stand for."""

    def fixed(m: re.Match) -> str:
        word = known.get(m.group().lower())
        return m.group() if word is None else word.upper() if m.group().isupper() and len(m.group()) > 1 else word.capitalize() if m.group()[0].isupper() else word

    lines, paragraphs, held = text.split("\n"), [], ""
    for n, line in enumerate(lines):
        if n in gone:
            continue
        if not line.strip():
            if held:
                paragraphs.append(held)
            held = ""
            continue
        known = correct.get(n, {})
        if known:
            line = _TOKEN.sub(fixed, line)
        if n in broken:
            line = line.rstrip()[:-1] + "\0"
        held = held[:-1] + line.lstrip() if held.endswith("\0") else f"{held} {line.strip()}" if held else line.strip() if n not in broken else line.lstrip()
    if held:
        paragraphs.append(held)
    return "\n\n".join(p.replace("\0", "") for p in paragraphs)


def repair_chunks(chunks: DataFrame) -> DataFrame:
    """(chunk_id, repaired_text) of all chunks; null where the text is null."""
    faults, doubts = scan_tables(chunks)
    lines = faults.where("fault <> 'misread'").groupBy("chunk_id").agg(F.collect_set(F.when(F.col("fault") != "break", F.col("line_no"))).alias("gone"), F.collect_set(F.when(F.col("fault") == "break", F.col("line_no"))).alias("broken"))
    words = doubts.where("part is null and correct is not null").groupBy("chunk_id").agg(F.collect_set(F.struct("line_no", "token", "correct")).alias("correct"))
    src = chunks.select(F.col("id").cast("string").alias("chunk_id"), "text").join(lines, "chunk_id", "left").join(words, "chunk_id", "left")

    def run(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                correct: dict[int, dict[str, str]] = {}
                for x in r["correct"] or ():
                    correct.setdefault(x["line_no"], {})[x["token"]] = x["correct"]
                out.append(None if r["text"] is None else repaired(r["text"], set(r["gone"] or ()), set(r["broken"] or ()), correct))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["chunk_id", "repaired_text"])

    return src.select("chunk_id", "text", "gone", "broken", "correct").mapInArrow(run, "chunk_id string, repaired_text string")
