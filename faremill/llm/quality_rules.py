"""Quality rules as a short-circuit cascade ordered by rejection per cost.

Every rule has a weight of its own: some read counters, some build arrays of words or windows.
On a sample each rule is timed and its rejections counted; rules then run in the order of
rejected share per second. A rule's columns are only computed for rows that no earlier rule has
rejected: every stage of a rule is guarded by "still alive", inside ``CASE WHEN``, which Spark
evaluates lazily. The verdict is a conjunction, so the order changes the cost and the rule that
is named, never what is kept.

All of it is DataFrame functions; a row is judged from its own text, so there is no shuffle.

Defined results: a null or empty text has no words and fails the base rule; a text of any length
is judged whole; repeated rows are judged alike; an empty table gives an empty result; columns of
the frame that share a name with a working column are left alone, as working names are chosen
anew. Windows are compared by 64-bit hashes: two different windows of one text of n words meet by
chance with a probability below n * n / 2**65.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import SPACES, fresh, stored, text_of, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """Rejects where ``verdict(columns)`` holds; ``stages`` build what it needs, one after another.

    Each stage maps names to functions of the columns built so far (by name), ``text`` and ``words``.
    """

    name: str
    stages: Sequence[dict[str, Callable[[dict[str, Column]], Column]]]
    verdict: Callable[[dict[str, Column]], Column]


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def _pairs(hashes: Column, step: int) -> Column:
    """Hash of each element with the one ``step`` places on."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(1 + step), n), lambda a, b: F.xxhash64(a, b))


def _doubled(windows: Column) -> Column:
    """(hash, position) of all windows in order, for texts in which some window comes twice."""
    tagged = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    has_twins = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(has_twins, F.array_sort(tagged))


def _twin_positions(ordered: Column) -> Column:
    """Positions of the windows that equal a neighbour in the order by hash."""

    def twin(pair: Column, at: Column) -> Column:
        same = F.lit(False)
        for other in (F.get(ordered, at - 1), F.get(ordered, at + 1)):
            same = same | F.coalesce(other["h"] == pair["h"], F.lit(False))
        return same

    return F.array_sort(F.transform(F.filter(ordered, twin), lambda pair: pair["i"]))


def _covered(positions: Column) -> Column:
    """Words that lie in one of the windows at ``positions``, which ascend."""
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("words"))
    add = lambda state, at: F.struct(
        at.alias("last"), (state["words"] + F.least(F.lit(WINDOW), at - state["last"])).alias("words")
    )
    return F.coalesce(F.aggregate(positions, start, add, lambda state: state["words"]), F.lit(0).cast("long"))


#: Words in windows found twice or more, by stages that each read the one before.
REPEATS = (
    {"hashed": lambda c: F.transform(c["words"], lambda w: F.xxhash64(w))},
    {"of_two": lambda c: _pairs(c["hashed"], 1)},
    {"of_four": lambda c: _pairs(c["of_two"], 2)},
    {"of_eight": lambda c: _pairs(c["of_four"], 4)},
    {"ordered": lambda c: _doubled(c["of_eight"])},
    {"twins": lambda c: _twin_positions(c["ordered"])},
    {"n_repeat_words": lambda c: _covered(c["twins"])},
)
LINES = (
    {"lines": lambda c: F.filter(F.split(c["text"], "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")},
    {"n_lines": lambda c: F.size(c["lines"]), "n_dup_lines": lambda c: F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))},
)
LETTERS = (
    {"bare": lambda c: F.regexp_replace(c["text"], r"[^\p{L}]+", "")},
    {"n_letters": lambda c: F.length(c["bare"]), "n_capitals": lambda c: F.length(F.regexp_replace(c["bare"], r"[^\p{Lu}]+", ""))},
)


def default_rules() -> list[Rule]:
    """Rules for prose in any language; thresholds are shares, far from what prose shows."""
    n = lambda c: F.size(c["words"])
    return [
        Rule("too_short", (), lambda c: n(c) < 20),
        Rule(
            "repeated_windows",
            REPEATS,
            lambda c: c["n_repeat_words"] * 100 > n(c) * 30,
        ),
        Rule(
            "symbols",
            ({"n_symbols": lambda c: F.length(c["text"]) - F.length(F.translate(c["text"], SYMBOLS, ""))},),
            lambda c: _share(c["n_symbols"], n(c)) > 0.1,
        ),
        Rule("repeated_lines", LINES, lambda c: _share(c["n_dup_lines"], c["n_lines"]) > 0.5),
        Rule("capitals", LETTERS, lambda c: _share(c["n_capitals"], c["n_letters"]) > 0.4),
        Rule(
            "stuttering",
            (
                {"follows": lambda c: F.slice(c["words"], F.lit(2), F.greatest(n(c) - 1, F.lit(0)))},
                {"n_stutters": lambda c: F.size(F.filter(F.zip_with(c["words"], c["follows"], lambda a, b: a == b), lambda same: same))},
            ),
            lambda c: _share(c["n_stutters"], n(c)) > 0.3,
        ),
        Rule(
            "wordless",
            ({"n_wordlike": lambda c: F.size(F.filter(c["words"], lambda w: F.rlike(w, F.lit(r"\p{L}"))))},),
            lambda c: _share(c["n_wordlike"], n(c)) < 0.6,
        ),
        Rule(
            "word_length",
            ({"word_chars": lambda c: F.length(F.translate(c["text"], SPACES, ""))},),
            lambda c: ~_share(c["word_chars"], n(c)).between(2, 15),
        ),
    ]


class _Columns:
    """Builds working columns of a frame under names that the frame doesn't have."""

    def __init__(self, df: DataFrame, text: str):
        self.df, self.kept, self.names = df, df.columns, {}
        self.set({"text": text_of(text)})
        self.set({"words": words_of(self["text"])})

    def __getitem__(self, name: str) -> Column:
        return F.col(self.names[name])

    def set(self, columns: dict[str, Column]) -> None:
        names = {name: fresh(self.df, f"__{name}") for name in columns}
        self.df = self.df.withColumns({names[name]: value for name, value in columns.items()})
        self.names |= names

    def build(self, stages: Sequence[dict[str, Callable]], guard: str | None) -> None:
        """Add the stages, for the rows in which ``guard`` is still null."""
        for stage in stages:
            made = {name: make(self) for name, make in stage.items()}
            if guard:
                made = {name: F.when(self[guard].isNull(), value) for name, value in made.items()}
            self.set(made)


def _cascade(columns: _Columns, rules: Sequence[Rule]) -> None:
    """Name the first rule that rejects each row in ``rejected_by``; null where none does."""
    columns.set({"rejected_by": F.lit(None).cast("string")})
    for rule in rules:
        columns.build(rule.stages, "rejected_by")
        alive = columns["rejected_by"].isNull()
        named = F.when(alive, F.when(rule.verdict(columns), F.lit(rule.name))).otherwise(columns["rejected_by"])
        columns.set({"rejected_by": named})


def _sealed(*columns: Column) -> Column:
    """The columns as one generated value: a caller's filter on them isn't pushed below the stages, where
    all of them would be written out inside it, once per use."""
    return F.explode(F.array(F.struct(*columns)))


def order_rules(
    df: DataFrame, rules: Sequence[Rule], text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 7
) -> list[Rule]:
    """Rules by rejected share per second on a random sample of about ``sample_rows`` rows.

    Only the order rests on the sample; each rule later judges every row it is shown.
    """
    count = df.count()
    share = min(1.0, sample_rows / max(count, 1))
    sample = stored(df.select(F.col(text).alias("text")).sample(share, seed), "rule-sample")
    sample.agg(F.max(F.length("text"))).collect()  # opens the files before the first rule is timed

    def measure(rule: Rule) -> float:
        start = time.perf_counter()
        columns = _Columns(sample, "text")
        _cascade(columns, [rule])
        seen = columns.df.agg(F.count(columns["rejected_by"]).alias("n"), F.count(F.lit(1)).alias("all")).first()
        seconds = time.perf_counter() - start
        return (seen.n + 1) / (seen["all"] + 1) / seconds

    scores = {rule.name: measure(rule) for rule in rules}
    return sorted(rules, key=lambda rule: -scores[rule.name])


def judge(
    df: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The frame's columns with ``kept`` and ``rejected_by`` (first rule that rejects, or null).

    Columns of those two names in the frame are replaced.
    """
    ordered = order_rules(df, rules or default_rules(), text, sample_rows)
    columns = _Columns(df.drop("kept", "rejected_by"), text)
    _cascade(columns, ordered)
    rejected = columns["rejected_by"]
    verdict = _sealed(rejected.isNull().alias("kept"), rejected.alias("rejected_by"))
    sealed = fresh(columns.df, "__verdict")
    return columns.df.select(*columns.kept, verdict.alias(sealed)).select(*columns.kept, f"{sealed}.*")


def keep_good(df: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, with the frame's own columns."""
    ordered = order_rules(df, default_rules(), text, sample_rows)
    columns = _Columns(df, text)
    _cascade(columns, ordered)
    # outer: other explodes get a filter on the array's size, which is pushed below the stages
    alive, mark = F.when(columns["rejected_by"].isNull(), F.array(F.lit(True))), fresh(columns.df, "__alive")
    marked = columns.df.select(*columns.kept, F.explode_outer(alive).alias(mark))
    return marked.where(F.col(mark)).select(*columns.kept)


def rule_report(df: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: the counters of the base rule, its verdict, and the cascade's.

    Counters that the cascade left out, as an earlier rule had rejected the row, are computed
    afterwards for those rows alone.
    """
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    ordered = order_rules(source, default_rules(), "text", sample_rows)
    columns = _Columns(source, "text")
    _cascade(columns, ordered)
    by = {rule.name: rule for rule in ordered}
    for counter, rule in (
        ("n_repeat_words", "repeated_windows"),
        ("n_dup_lines", "repeated_lines"),
        ("n_symbols", "symbols"),
        ("word_chars", "word_length"),
    ):
        columns.set({f"first_{counter}": columns[counter]})
        columns.build(by[rule].stages, f"first_{counter}")
        columns.set({counter: F.coalesce(columns[f"first_{counter}"], columns[counter]).cast("long")})
    n_words = F.size(columns["words"]).cast("long")
    base_failed = (n_words < 20) | (columns["n_repeat_words"] * 100 > n_words * 30)
    report = _sealed(
        n_words.alias("n_words"),
        *(columns[name].alias(name) for name in ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        base_failed.alias("base_failed"),
        columns["rejected_by"].isNull().alias("kept"),
    )
    return columns.df.select("doc_id", report.alias("report")).select("doc_id", "report.*")
