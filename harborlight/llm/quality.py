"""Quality rules: a threshold table compiled into one projection.

Every metric is a column expression over the document's words and lines, every
rule compares one metric with one number, and the whole table becomes a single
``select`` without user functions, joins or shuffles.  Words are runs of characters
other than ASCII blanks.

Stop words are counted in lower case without marks at their ends, and only asked of texts
in a language of the list: by the ``lang`` column, or by the Latin script without it.

Defined cases: a null or empty text has no words and fails ``words``; repeated rows
are judged one by one; an empty table gives an empty result; other columns of the
input pass through ``keep_good`` untouched and never clash, because the metrics
live in one struct column that is dropped again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight.llm.common import NOT_BLANK, blank_words, let, text_or_empty

SYMBOLS = "#*$%&|<>"
WINDOW = 5
STOP_WORDS = (
    # fixed values: frequent function words of four languages
    "the be to of and a in that have with is was for on as by it or at from this are".split()
    + "le la les de du des et un une en que qui dans pour par sur au est".split()
    + "der die das und von zu mit den ein eine auf ist nicht sich als für im auch".split()
    + "el los las y se por con para su no es lo".split()
)
#: codes of their languages; texts of others are not asked for stop words
STOP_LANGS = "en eng fr fra fre de deu ger es spa".split()
#: codes that name no language: the script decides
NO_LANGS = ["", "und", "unk", "unknown", "mul", "zxx"]
#: marks that may stand at the ends of a word
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»“”„‘’‚‹›…–—"


@dataclass(frozen=True)
class Rule:
    """Reject a document when ``metric`` is below ``least`` or above ``most``."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None

    def failed(self, metrics: Column) -> Column:
        value = metrics[self.metric]
        tests = [value < F.lit(self.least)] if self.least is not None else []
        tests += [value > F.lit(self.most)] if self.most is not None else []
        return tests[0] if len(tests) == 1 else tests[0] | tests[1]


BASE_RULES = (
    Rule("words", "n_words", least=10),
    Rule("repetition", "repeat_percent_scaled", most=0),
)
OWN_RULES = (
    Rule("word_length", "mean_word_chars", least=1.5, most=20.0),
    Rule("symbols", "symbols_per_word", most=0.3),
    Rule("stop_words", "stop_shortfall", most=0),
    Rule("duplicate_lines", "dup_line_share", most=0.5),
    Rule("ellipsis_lines", "ellipsis_line_share", most=0.5),
    Rule("bullet_lines", "bullet_line_share", most=0.95),
)
#: one stop word is expected in this many words; shorter texts may have none
WORDS_PER_STOP_WORD = 60


def _windows(words: Column) -> Column:
    starts = F.sequence(F.lit(0), F.size(words) - F.lit(WINDOW))
    return F.transform(
        starts, lambda i: F.xxhash64(*(F.get(words, i + F.lit(k)) for k in range(WINDOW)))
    )


def _exact_repeats(words: Column) -> Column:
    """Words inside windows that occur more than once, by sorting the windows themselves."""
    starts = F.sequence(F.lit(0), F.size(words) - F.lit(WINDOW))
    windows = F.transform(
        starts,
        lambda i: F.struct(
            *(F.get(words, i + F.lit(k)).alias(f"w{k}") for k in range(WINDOW)), i.alias("at")
        ),
    )

    def same(a: Column, b: Column) -> Column:
        tests = [a[f"w{k}"].eqNullSafe(b[f"w{k}"]) for k in range(WINDOW)]
        joined = tests[0]
        for test in tests[1:]:
            joined = joined & test
        return joined

    def found(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda x, i: same(x, F.get(ordered, i - F.lit(1)))
            | same(x, F.get(ordered, i + F.lit(1))),
        )

    def covered(at: Column) -> Column:
        gaps = F.transform(
            at,
            lambda p, i: F.least(
                F.lit(WINDOW), F.coalesce(F.get(at, i + F.lit(1)) - p, F.lit(WINDOW))
            ),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, g: total + g)

    repeated = let(F.array_sort(windows), found)
    return let(F.array_sort(F.transform(repeated, lambda x: x["at"])), covered)


def _repeat_words(words: Column) -> Column:
    """Hashes settle the usual case of no repeat; equal hashes are checked word by word."""
    hashed = let(
        _windows(words),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            _exact_repeats(words)
        ),
    )
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(hashed)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def _plain(word: Column) -> Column:
    return F.btrim(F.lower(word), F.lit(MARKS))


def _covered(text: Column, lang: Column | None) -> Column:
    """Whether stop words of a text's language are listed: by its code, or else by its script."""
    ascii_only = F.octet_length(text) == F.length(text)
    others = F.regexp_count(text, F.lit(r"[\p{L}&&[^\p{IsLatin}]]"))
    latin = ascii_only | (others <= F.regexp_count(text, F.lit(r"\p{IsLatin}")))
    if lang is None:
        return latin
    code = F.lower(F.trim(F.regexp_extract(F.coalesce(lang, F.lit("")), "^[^-_]*", 0)))
    return F.when(code.isin(NO_LANGS), latin).otherwise(code.isin(STOP_LANGS))


def _lang(docs: DataFrame, column: str) -> Column | None:
    return F.col(column).cast("string") if column in docs.columns else None


def metrics(text: Column, lang: Column | None = None) -> Column:
    """All metrics of one text as a struct."""

    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_BLANK))
        return let(blank_words(t), lambda w: let(lines, lambda ln: counted(t, w, ln)))

    def counted(t: Column, w: Column, ln: Column) -> Column:
        stops = F.size(F.filter(w, lambda x: _plain(x).isin(STOP_WORDS)))
        counts = F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
            F.size(ln).cast("long").alias("n_lines"),
            (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(ln, lambda x: F.rtrim(x).endswith("..."))).alias("n_ellipsis"),
            F.size(F.filter(ln, lambda x: F.ltrim(x).rlike("^[-*•]"))).alias("n_bullets"),
            stops.cast("long").alias("n_stop_words"),
            _repeat_words(w).cast("long").alias("n_repeat_words"),
        )
        return let(counts, lambda c: rated(t, c))

    def rated(t: Column, c: Column) -> Column:
        names = "n_words word_chars n_symbols n_lines n_dup_lines n_stop_words n_repeat_words"
        shortfall = F.floor(c["n_words"] / F.lit(WORDS_PER_STOP_WORD)) - c["n_stop_words"]
        return F.struct(
            *(c[n].alias(n) for n in names.split()),
            (100 * c["n_repeat_words"] - 20 * c["n_words"]).alias("repeat_percent_scaled"),
            _ratio(c["word_chars"], c["n_words"]).alias("mean_word_chars"),
            _ratio(c["n_symbols"], c["n_words"]).alias("symbols_per_word"),
            F.when((shortfall <= 0) | _covered(t, lang), shortfall)
            .otherwise(F.lit(0).cast("long"))
            .alias("stop_shortfall"),
            _ratio(c["n_dup_lines"], c["n_lines"]).alias("dup_line_share"),
            _ratio(c["n_ellipsis"], c["n_lines"]).alias("ellipsis_line_share"),
            _ratio(c["n_bullets"], c["n_lines"]).alias("bullet_line_share"),
        )

    return let(text, of)


def verdict(measured: Column, rules: tuple[Rule, ...]) -> Column:
    """Names of the rules a document breaks."""
    names = F.array(*(F.when(r.failed(measured), F.lit(r.name)) for r in rules))
    return F.filter(names, lambda n: n.isNotNull())


def judge(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: tuple[Rule, ...] = BASE_RULES + OWN_RULES,
    lang_column: str = "lang",
) -> DataFrame:
    """One row per document: its id, the ``metrics`` struct and the ``broken`` rules."""
    measured = docs.select(
        F.col(id_column).alias("doc_id"), metrics(text_or_empty(text_column), _lang(docs, lang_column)).alias("metrics")
    )
    return measured.select("doc_id", "metrics", verdict(F.col("metrics"), rules).alias("broken"))


def keep_good(
    docs: DataFrame,
    text_column: str = "text",
    rules: tuple[Rule, ...] = BASE_RULES + OWN_RULES,
    lang_column: str = "lang",
) -> DataFrame:
    """The rows of ``docs`` that break no rule, with their columns as they were."""
    measured = metrics(text_or_empty(text_column), _lang(docs, lang_column))
    # a metrics column would be copied into every rule below the filter
    return docs.filter(let(measured, lambda m: F.size(verdict(m, rules)) == 0))
