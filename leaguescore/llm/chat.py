"""Chat formatting with compiled templates.

A template is text with ``{{ expression }}``, ``{% for x in y %}``, ``{% if e %}`` (``elif``,
``else``), ``{% set x = e %}`` and ``{% generation %}``, which marks what a model is to learn.
It is parsed into a syntax tree, constant parts are folded, and the tree becomes Python closures.
Nothing of Python is reachable from a template: it has names given to it, its own operators,
fields of plain mappings, and the filters of ``FILTERS``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, fields, is_dataclass
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leaguescore.llm.runtime import map_arrow, pieces_of, stored

#: One turn: a header with the role, the text, an end mark.
TURNS = (
    "{% for m in messages %}### {{ m.role | escape_role }}: "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
CONTROL = re.compile(r"\\|#(?=##)|<(?=/turn>)")
ROLE_CONTROL = re.compile(r"\\|#(?=##)|<(?=/turn>)|:|\n")
TURN = re.compile(
    r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL
)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
#: Turns and characters of a conversation that are rendered at once; what comes out is the same for any.
PART_TURNS = 256
PART_CHARS = 4 << 20
#: Longer conversations are dealt to several tasks, in at most so many segments.
SEGMENT_TURNS = 8_192
MOST_SEGMENTS = 1_000


class TemplateError(ValueError):
    """The template is not in the language."""


# --- what templates can call -------------------------------------------------


def escape(text: str) -> str:
    """A backslash before whatever could be read as a mark of the template."""
    return CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


#: Filters take what would be shown: of a missing field the empty text. Only ``length`` looks at lists.
FILTERS: dict[str, Callable[[object], object]] = {
    "escape": lambda value: escape(shown(value)),
    "escape_role": lambda value: ROLE_CONTROL.sub(r"\\\g<0>", shown(value)),
    "trim": lambda value: shown(value).strip(),
    "upper": lambda value: shown(value).upper(),
    "lower": lambda value: shown(value).lower(),
    "length": lambda value: len(value) if isinstance(value, (list, dict)) else len(shown(value)),
}

# --- syntax tree -------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Get:
    of: object
    name: str


@dataclass(frozen=True)
class Call:
    function: str
    of: object


@dataclass(frozen=True)
class Op:
    op: str
    left: object
    right: object = None


@dataclass(frozen=True)
class Out:
    value: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    test: object
    body: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- parser ------------------------------------------------------------------

TAGS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\})", re.DOTALL)
LEXEMES = re.compile(
    r"\s*(?:(?P<text>'[^']*'|\"[^\"]*\")|(?P<number>\d+)|(?P<word>[A-Za-z]\w*)"
    r"|(?P<sign>==|!=|<=|>=|[<>+\-%|.()]))"
)


def lexemes(source: str) -> list[tuple[str, str]]:
    found, at = [], 0
    source = source.rstrip()
    while at < len(source):
        match = LEXEMES.match(source, at)
        if not match:
            raise TemplateError(f"not understood: {source[at:]!r}")
        found.append((match.lastgroup, match[match.lastgroup]))
        at = match.end()
    return found


class Expression:
    """Recursive descent: or, and, not, comparison, sum, postfix (``.name``, ``| filter``)."""

    def __init__(self, source: str) -> None:
        self.left = lexemes(source)

    def peek(self) -> str | None:
        return self.left[0][1] if self.left and self.left[0][0] != "text" else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() is not None and self.peek() in wanted:
            return self.left.pop(0)[1]
        return None

    def whole(self) -> object:
        tree = self.either()
        if self.left:
            raise TemplateError(f"not understood: {self.left[0][1]!r}")
        return tree

    def chain(self, below: Callable, *ops: str) -> object:
        tree = below()
        while op := self.take(*ops):
            tree = fold(Op(op, tree, below()))
        return tree

    def either(self) -> object:
        return self.chain(self.both, "or")

    def both(self) -> object:
        return self.chain(self.negated, "and")

    def negated(self) -> object:
        return fold(Op("not", self.negated())) if self.take("not") else self.compared()

    def compared(self) -> object:
        return self.chain(self.added, "==", "!=", "<=", ">=", "<", ">")

    def added(self) -> object:
        return self.chain(self.postfix, "+", "-", "%")

    def postfix(self) -> object:
        tree = self.atom()
        while sign := self.take(".", "|"):
            name = self.word()
            if sign == ".":
                tree = Get(tree, name)
            elif name not in FILTERS:
                raise TemplateError(f"no such filter: {name}")
            else:
                tree = fold(Call(name, tree))
        return tree

    def word(self) -> str:
        if not self.left or self.left[0][0] != "word":
            raise TemplateError("a name is missing")
        return self.left.pop(0)[1]

    def atom(self) -> object:
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("a parenthesis is not closed")
            return tree
        if not self.left:
            raise TemplateError("an expression ends early")
        kind, text = self.left.pop(0)
        if kind == "text":
            return Const(text[1:-1])
        if kind == "number":
            return Const(int(text))
        if kind != "word":
            raise TemplateError(f"not understood: {text!r}")
        constants = {"true": True, "false": False, "none": None}
        return Const(constants[text]) if text in constants else Name(text)


OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "%": lambda a, b: a % b,
}


def fold(tree: object) -> object:
    """The constant that an expression of constants has; names are never looked at."""
    if isinstance(tree, Call) and isinstance(tree.of, Const):
        return Const(FILTERS[tree.function](tree.of.value))
    if isinstance(tree, Op) and isinstance(tree.left, Const):
        left = tree.left.value
        if tree.op == "not":
            return Const(not left)
        if tree.op == "and":
            return tree.right if left else tree.left
        if tree.op == "or":
            return tree.left if left else tree.right
        if isinstance(tree.right, Const):
            return Const(OPERATORS[tree.op](left, tree.right.value))
    return tree


def parse(source: str) -> tuple:
    """A template's statements; constant conditions and adjacent texts are folded."""
    parts = TAGS.split(source)
    body, at = block(parts, 0, ())
    if at != len(parts):
        raise TemplateError(f"out of place: {parts[at]}")
    return body


def block(parts: list[str], at: int, ends: tuple[str, ...]) -> tuple[tuple, int]:
    """Statements up to a tag of ``ends``, and where that is."""
    body: list = []
    while at < len(parts):
        part = parts[at]
        if part.startswith("{{"):
            body.append(Out(Expression(part[2:-2]).whole()))
        elif part.startswith("{%"):
            tag = part[2:-2].strip()
            word = tag.partition(" ")[0]
            if word in ends:
                return joined(body), at
            made, at = statement(parts, at, word, tag[len(word) :])
            body.extend(made)
        elif part:
            body.append(Out(Const(part)))
        at += 1
    if ends:
        raise TemplateError(f"{ends[-1]} is missing")
    return joined(body), at


def statement(parts: list[str], at: int, word: str, rest: str) -> tuple[tuple, int]:
    if word == "for":
        name, found, over = rest.partition(" in ")
        if not found or not re.fullmatch(r"[A-Za-z]\w*", name.strip()):
            raise TemplateError(f"not a loop: {rest}")
        body, at = block(parts, at + 1, ("endfor",))
        return (For(name.strip(), Expression(over).whole(), body),), at
    if word == "if":
        test = Expression(rest).whole()
        body, at = block(parts, at + 1, ("elif", "else", "endif"))
        tag = parts[at][2:-2].strip()
        other: tuple = ()
        if tag.startswith("elif"):
            other, at = statement(parts, at, "if", tag[4:])
        elif tag == "else":
            other, at = block(parts, at + 1, ("endif",))
        if isinstance(test, Const):
            return (body if test.value else other), at
        return (If(test, body, other),), at
    if word == "generation":
        body, at = block(parts, at + 1, ("endgeneration",))
        return (Generation(body),), at
    if word == "set":
        name, found, value = rest.partition("=")
        if not found or not re.fullmatch(r"[A-Za-z]\w*", name.strip()):
            raise TemplateError(f"not understood: {rest}")
        return (Set(name.strip(), Expression(value).whole()),), at
    raise TemplateError(f"no such statement: {word}")


def joined(body: list) -> tuple:
    """Adjacent constant texts as one."""
    out: list = []
    for item in body:
        constant = isinstance(item, Out) and isinstance(item.value, Const)
        if constant:
            item = Out(Const(shown(item.value.value)))
            if out and isinstance(out[-1], Out) and isinstance(out[-1].value, Const):
                item = Out(Const(out.pop().value.value + item.value.value))
        out.append(item)
    return tuple(out)


def shown(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


# --- compiler ----------------------------------------------------------------


@dataclass
class Page:
    """What has been rendered, and which spans of it are to be learnt."""

    parts: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    size: int = 0

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


def value_of(tree: object) -> Callable[[dict], object]:
    """An expression as a closure over the names' values."""
    if isinstance(tree, Const):
        return lambda names, v=tree.value: v
    if isinstance(tree, Name):
        return lambda names, n=tree.name: names.get(n)
    if isinstance(tree, Get):
        of = value_of(tree.of)

        def get(names: dict, n: str = tree.name) -> object:
            owner = of(names)
            return owner.get(n) if isinstance(owner, dict) else None

        return get
    if isinstance(tree, Call):
        function, of = FILTERS[tree.function], value_of(tree.of)
        return lambda names: function(of(names))
    left = value_of(tree.left)
    if tree.op == "not":
        return lambda names: not left(names)
    right = value_of(tree.right)
    if tree.op == "and":
        return lambda names: left(names) and right(names)
    if tree.op == "or":
        return lambda names: left(names) or right(names)
    operator = OPERATORS[tree.op]
    return lambda names: operator(left(names), right(names))


def writer_of(body: tuple) -> Callable[[dict, Page], None]:
    """Statements as one closure that writes to a page."""
    steps = [step_of(item) for item in body]

    def run(names: dict, page: Page) -> None:
        for step in steps:
            step(names, page)

    return steps[0] if len(steps) == 1 else run


def step_of(item: object) -> Callable[[dict, Page], None]:
    if isinstance(item, Out):
        if isinstance(item.value, Const):
            return lambda names, page, text=item.value.value: page.write(text)
        value = value_of(item.value)
        return lambda names, page: page.write(shown(value(names)))
    if isinstance(item, Set):
        value = value_of(item.value)
        return lambda names, page: names.update({item.name: value(names)})
    if isinstance(item, If):
        test, body, other = value_of(item.test), writer_of(item.body), writer_of(item.other)
        return lambda names, page: (body if test(names) else other)(names, page)
    inner = writer_of(item.body)
    if isinstance(item, Generation):

        def learn(names: dict, page: Page) -> None:
            start = page.size
            inner(names, page)
            page.spans.append((start, page.size))

        return learn
    over = value_of(item.over)

    def loop(names: dict, page: Page) -> None:
        values = list(over(names) or ())
        for k, value in enumerate(values):
            inner({**names, item.name: value, "loop": place_of(k, k == len(values) - 1)}, page)

    return loop


def compile_template(source: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """From names to the text and the spans (code points) of the ``generation`` blocks."""
    write = writer_of(parse(source))

    def render(names: dict) -> tuple[str, list[tuple[int, int]]]:
        page = Page()
        write(dict(names), page)
        return "".join(page.parts), page.spans

    return render


def place_of(k: int, last: bool) -> dict:
    return {"index": k + 1, "first": k == 0, "last": last}


def mentions(tree: object, name: str) -> bool:
    """Is a name used, or given another value, anywhere in statements or an expression?"""
    if isinstance(tree, tuple):
        return any(mentions(t, name) for t in tree)
    if isinstance(tree, (Name, Set, For)) and tree.name == name:
        return True
    return is_dataclass(tree) and any(mentions(getattr(tree, f.name), name) for f in fields(tree))


class Layout:
    """A template that can be rendered in parts, where it allows that.

    It does if it has one loop over ``messages`` outside of all blocks and uses them nowhere else. What is before the loop
    is then written with the first message, what is after it with the last, and ``loop`` counts on from part to part:
    so the parts of a conversation together are what it is as a whole.
    """

    def __init__(self, source: str) -> None:
        body = parse(source)
        loops = [i for i, item in enumerate(body) if isinstance(item, For) and item.over == Name("messages")]
        at = loops[0] if loops else 0
        rest = (*body[:at], *body[at].body, *body[at + 1 :]) if loops else ()
        self.in_parts = bool(loops) and not mentions(rest, "messages")
        self.whole = compile_template(source)
        if self.in_parts:
            self.before, self.after = writer_of(body[:at]), writer_of(body[at + 1 :])
            self.name, self.inner = body[at].name, writer_of(body[at].body)

    def part(self, messages: list[dict], start: int, last: bool) -> tuple[str, list[tuple[int, int]]]:
        """Text and spans of the messages from number ``start`` on."""
        page, names = Page(), {"messages": None}
        self.before(names, Page() if start else page)
        for k, message in enumerate(messages, start):
            place = place_of(k, last and k == start + len(messages) - 1)
            self.inner({**names, self.name: message, "loop": place}, page)
        if last:
            self.after(names, page)
        return "".join(page.parts), page.spans


# --- Spark -------------------------------------------------------------------


def segmented(turns: DataFrame, segment_turns: int) -> DataFrame:
    """The turns with ``segment``, ``start`` (its first turn's number) and ``is_last``.

    Conversations of more turns than ``segment_turns`` are cut at quantiles of ``turn``, so that one which holds a
    third of all rows is dealt to many tasks. Turns of one number are not parted. Only these conversations cost
    more than a count; there are at most as many as the table has segments.
    """
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > segment_turns)
    known = counts.agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("n")).first()
    plain = turns.withColumns({"segment": F.lit(0), "start": F.lit(0).cast("long"), "is_last": F.lit(True)})
    if not known["n"]:
        return plain
    pieces = min(MOST_SEGMENTS, -(-known["most"] // segment_turns))
    small = known["n"] * pieces * 32 <= SMALL_BYTES

    def attach(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
        renamed = right.withColumnsRenamed({k: f"{k}_" for k in keys})
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
        side = F.broadcast(renamed) if small else renamed.hint("merge")
        return left.join(side, same, "left").drop(*[f"{k}_" for k in keys])

    shares = [i / pieces for i in range(1, pieces)] or [0.5]
    long = attach(turns.select("conv_id", "turn"), counts, "conv_id").where("n IS NOT NULL")
    cuts = stored(long.groupBy("conv_id").agg(F.percentile_approx("turn", shares, 10_000).alias("cuts")), "cuts")
    segment = F.size(F.filter("cuts", lambda cut: cut < F.col("turn")))
    cut = attach(turns, cuts, "conv_id").withColumn(
        "segment", F.when(F.col("cuts").isNull() | F.col("turn").isNull(), 0).otherwise(segment)
    )
    sizes = cut.where("cuts IS NOT NULL").groupBy("conv_id", "segment").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("conv_id").orderBy("segment")  # at most MOST_SEGMENTS rows each
    places = stored(
        sizes.select(
            "conv_id",
            "segment",
            (F.sum("n").over(order) - F.col("n")).alias("start"),
            F.lead("segment").over(order).isNull().alias("is_last"),
        ),
        "places",
    )
    placed = attach(cut.drop("cuts"), places, "conv_id", "segment")
    return placed.withColumns(
        {
            "start": F.coalesce("start", F.lit(0)).cast("long"),
            "is_last": F.coalesce("is_last", F.lit(True)),
        }
    )


#: Bytes of cuts that are sent to every task; more are joined by a shuffle.
SMALL_BYTES = 16 << 20


def format_conversations(
    conversations: DataFrame, template: str = TURNS, segment_turns: int = SEGMENT_TURNS
) -> DataFrame:
    """``(conv_id, part, formatted, spans)``: every conversation rendered by the template.

    Turns are ordered by ``turn``, a number (null first), then role and text. Null roles and texts
    are empty, a null ``conv_id`` is a conversation too, rows may repeat, and other columns are not looked at.
    A conversation's parts by ascending ``part`` are its text; ``spans`` are code points of their part. Where the template can be
    rendered in parts (``Layout``), long conversations come in several, from several tasks, and no task holds one whole.
    Where it cannot, as when it asks for the number of messages, each conversation is one part.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    turns = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    in_parts = Layout(template).in_parts
    placed = segmented(turns, segment_turns if in_parts else NEVER)
    dealt = (
        placed.select("conv_id", "segment", "start", "is_last", "turn", "role", "text")
        .repartition("conv_id", "segment")
        .sortWithinPartitions("conv_id", "segment", "turn", "role", "text")
    )

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = Layout(template)
        now, held, size, done, rows = None, [], 0, 0, []

        def page(ends: bool) -> None:
            """What is held, as the segment's next part; ``ends``: it has no more."""
            nonlocal held, size, done
            conv, segment, start, is_last = now
            if in_parts:
                text, spans = layout.part(held, start + done, ends and is_last)
            else:
                text, spans = layout.whole({"messages": held})
            place = (segment << 32) + done
            rows.append((conv, place, text, [{"start": s, "end": e} for s, e in spans]))
            done, held, size = done + len(held), [], 0

        def flushed(like: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 4
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            kinds = [like, pa.int64(), pa.string(), span]
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(made, ["conv_id", "part", "formatted", "spans"])

        like = None
        for batch in batches:
            like = batch.column(0).type
            for conv, segment, start, is_last, _, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if now is not None and now[:2] != (conv, segment):
                    page(True)
                    done = 0
                elif in_parts and (len(held) >= PART_TURNS or size > PART_CHARS):
                    page(False)
                now = (conv, segment, start, is_last)
                held.append({"role": role, "text": text})
                size += len(text)
                if len(rows) >= 1000:
                    yield flushed(like)
            if rows:
                yield flushed(like)
        if now is not None:
            page(True)
            yield flushed(like)

    spans = "array<struct<start: long, end: long>>"
    return map_arrow(dealt, formatted, f"conv_id {kind}, part long, formatted string, spans {spans}")


#: More turns than any conversation has.
NEVER = 1 << 62


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of text in the ``TURNS`` template."""
    turns, at = [], 0
    while at < len(formatted):
        match = TURN.match(formatted, at)
        if not match:
            raise ValueError("not in the turns template")
        turns.append((unescape(match[1]), unescape(match[2])))
        at = match.end()
    return turns


def read_parts(formatted: DataFrame) -> DataFrame:
    """``(conv_id, part, n, said, learnt, size)``: each part read back by itself, wherever it is."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "formatted"):
            n, said, learnt, sizes = [], [], [], []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                turns = read_turns(text)
                n.append(len(turns))
                said.append("".join(f"{role}\n{words}\n" for role, words in turns))
                learnt.append("".join(unescape(text[s["start"] : s["end"]]) for s in spans))
                sizes.append(len(text))
            long, texts = pa.int64(), pa.string()
            made = [pa.array(n, long), pa.array(said, texts), pa.array(learnt, texts), pa.array(sizes, long)]
            names = ["conv_id", "part", "n", "said", "learnt", "size"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=names)

    schema = f"conv_id {kind}, part long, n long, said string, learnt string, size long"
    return map_arrow(formatted.select("conv_id", "part", "formatted", "spans"), read, schema)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what ``format_conversations`` gave in the ``TURNS`` template, from its text and spans alone.

    ``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``, a row for
    each conversation. Parts are read where they are; only a digest, which has an order, takes those of a conversation
    one after another, and holds none of them.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()
    ordered = read_parts(formatted).repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def row(like: pa.DataType) -> pa.RecordBatch:
            n, turns, chars, loss, size = state
            values = [now], [n], [turns.hexdigest()], [chars], [loss.hexdigest()], [size]
            long, text = pa.int64(), pa.string()
            kinds = [like, long, text, long, text, long]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], [*names, "formatted_chars"]
            )

        done: list[pa.RecordBatch] = []
        like = None
        for batch in batches:
            like = batch.column(0).type
            for conv, _, n, said, learnt, size in zip(*[c.to_pylist() for c in batch.columns]):
                if state is not None and conv != now:
                    done.append(row(like))
                    state = None
                if state is None:
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += n
                state[1].update(said.encode())
                state[2] += len(learnt)
                state[3].update(learnt.encode())
                state[4] += size
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                done = []
        if state is not None:
            yield row(like)

    schema = (
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    return map_arrow(ordered, digested, schema)
