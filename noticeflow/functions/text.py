"""Text cleaning and extraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import COUNT_TOLERANCE, FALLBACK_TITLE, HARD_LIMIT

ColumnOrName = Column | str

# Everything Unicode calls white space, which plain trim() does not cover.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of an intermediate value that is computed once and used many times.

    A Column is an expression tree: using one in five places copies it five
    times, and the optimizer has to walk every copy.
    """
    return F.transform(F.array(value), body)[0]


class Stages:
    """``bind`` by projections: each intermediate value is a column of its own.

    Values in projections run in generated code, those inside ``bind`` above one
    row at a time, so use this where rows are many:

        steps = Stages(rows)
        verdict = validate_verdict(parse_verdict("body", steps.bind), bind=steps.bind)
        rows = steps.done(verdict=verdict)
    """

    def __init__(self, rows: DataFrame):
        self.rows, self.names = rows, []

    def bind(self, value: Column, body: Callable[[Column], Column]) -> Column:
        name = f"_stage{len(self.names)}"
        self.names.append(name)
        self.rows = self.rows.withColumn(name, value)
        return body(F.col(name))

    def done(self, **columns: Column) -> DataFrame:
        return self.rows.withColumns(columns).drop(*self.names)


def _stripped(value: ColumnOrName) -> Column:
    return F.btrim(as_col(value).cast("string"), F.lit(WHITESPACE))


def clean(value: ColumnOrName) -> Column:
    """Strip Unicode white space; blank becomes NULL.

    ``btrim`` with a character set is code-generated, so a long body is not
    walked by a regular expression.
    """
    return F.nullif(_stripped(value), F.lit(""))


def is_blank(value: ColumnOrName) -> Column:
    return F.coalesce(_stripped(value) == "", F.lit(True))


def truncate(value: ColumnOrName, length: int) -> Column:
    """First ``length`` code points."""
    return F.left(as_col(value), F.lit(length))


def fits_or_blank(value: ColumnOrName, length: int) -> Column:
    """The value if it has at most ``length`` characters, else NULL."""
    value = as_col(value)
    return F.when(F.length(value) <= length, value)


def title_fallback(title: ColumnOrName, project: ColumnOrName, content: ColumnOrName,
                   default: str = FALLBACK_TITLE, content_chars: int = 80) -> Column:
    return F.coalesce(clean(title), clean(project), truncate(clean(content), content_chars),
                      F.lit(default))


# Fixed pattern: a hyperlink formula is URL text, a comma or semicolon, display
# text up to the final quote (stray quotes in a title are tolerated).
HYPERLINK_PATTERN = r'(?isU)\AHYPERLINK\(\s*"([^"]*)"\s*[,;]\s*"(.*)"\s*\)\z'


def _formula_body(formula: ColumnOrName) -> Column:
    return F.btrim(F.ltrim(as_col(formula), F.lit("=")), F.lit(WHITESPACE))


def is_hyperlink(formula: ColumnOrName) -> Column:
    return _formula_body(formula).rlike(HYPERLINK_PATTERN)


def hyperlink_text(formula: ColumnOrName) -> Column:
    """Visible text of a HYPERLINK formula, its URL when the text is empty.

    NULL for any other formula; test with :func:`is_hyperlink` to abort.
    """
    body = _formula_body(formula)
    target, display = (
        F.replace(F.regexp_extract(body, HYPERLINK_PATTERN, group), F.lit('""'), F.lit('"'))
        for group in (1, 2)
    )
    return F.when(body.rlike(HYPERLINK_PATTERN), F.coalesce(F.nullif(display, F.lit("")), target))


def _distinct_numbers(text: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: x.try_cast("bigint")))


def labelled_counts(text: ColumnOrName, labels: dict[str, str], bind=bind) -> Column:
    """Integer shown after each label; all copies of a label must agree.

    ``labels`` maps output field -> label text. Returns a struct of those fields
    plus ``error`` (name of the first field that is missing or contradictory).
    """
    def search(shown: Column) -> Column:
        return F.struct(*[
            _distinct_numbers(shown, rf"\Q{label}\E\s*[:：]?\s*([0-9]+)\s*条").alias(name)
            for name, label in labels.items()])

    def agreed(numbers: Column) -> Column:
        fields = [F.when(F.size(numbers[n]) == 1, numbers[n][0]).alias(n) for n in labels]
        error = F.coalesce(*[F.when(F.size(numbers[n]) != 1, F.lit(n)) for n in labels])
        return F.struct(*fields, error.alias("error"))

    return bind(bind(as_col(text), search), agreed)


# Labels of the order page.
ORDER_LABELS = {"taken": "本次扣除", "balance": "今日限量余额", "remaining": "本日仍可导出"}
FEE_LABELS = "实付金额|应付金额|应付总额"
FEE_PATTERN = rf"(?:{FEE_LABELS})\s*[:：]?\s*[¥￥]?\s*([0-9]+(?:\.[0-9]+)?)\s*(?:元)?(?=\s|$)"


def order_ledger(text: ColumnOrName, limit: int = HARD_LIMIT, bind=bind) -> Column:
    """Order page text -> struct(taken, balance, remaining, error).

    Every fee shown must be a readable zero, every count must be unambiguous,
    and 0 < taken <= min(limit, balance) with remaining = balance - taken.
    """
    def search(shown: Column) -> Column:
        fees = F.regexp_extract_all(shown, F.lit(FEE_PATTERN), F.lit(1))
        return F.struct(labelled_counts(shown, ORDER_LABELS, bind).alias("counts"), fees.alias("fees"),
                        F.regexp_count(shown, F.lit(FEE_LABELS)).alias("fees_shown"))

    def checked(page: Column) -> Column:
        taken, balance, remaining = (page["counts"][name] for name in ORDER_LABELS)
        consistent = ((taken > 0) & (taken <= F.least(F.lit(limit), balance))
                      & (remaining == balance - taken))
        free = (page["fees_shown"] == F.size(page["fees"])) & F.forall(
            page["fees"], lambda x: F.coalesce(x.try_cast("decimal(38,18)") == 0, F.lit(False)))
        error = (F.when(~free, F.lit("fee"))
                 .when(page["counts"]["error"].isNotNull(), page["counts"]["error"])
                 .when(~consistent, F.lit("quota")))
        return F.struct(taken.alias("taken"), balance.alias("balance"), remaining.alias("remaining"),
                        error.alias("error"))

    return bind(bind(as_col(text), search), checked)


# Fixed pattern: result counter of a filter page.
DISPLAYED_PATTERN = r"为您筛选到\s*([0-9]+)\s*条数据"


def displayed_count(text: ColumnOrName, tolerance: int = COUNT_TOLERANCE,
                    pattern: str = DISPLAYED_PATTERN) -> Column:
    """Largest repeated counter -> struct(count, spread, error)."""
    def widest(values: Column) -> Column:
        spread = F.array_max(values) - F.array_min(values)
        error = F.when(F.size(values) == 0, F.lit("missing")).when(spread > tolerance, F.lit("spread"))
        return F.struct(F.when((F.size(values) > 0) & (spread <= tolerance), F.array_max(values)).alias("count"),
                        spread.alias("spread"), error.alias("error"))

    return bind(_distinct_numbers(as_col(text), pattern), widest)


# Fixed values of the error summary.
NO_ERROR_TEXT = "任务异常结束，未取得具体错误信息"
ERROR_LINE = r"^[\w.]+(?:Error|Exception):\s*\S"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def last_error_line(text: ColumnOrName, length: int | None = None) -> Column:
    """Last ``SomeError: ...`` line, else the last non-blank line; ANSI codes removed. ``length`` cuts it."""
    plain = F.regexp_replace(F.coalesce(as_col(text), F.lit("")), "\\x1b\\[[0-9;]*m", "")
    lines = F.transform(F.split(plain, LINE_BREAK, -1), lambda x: F.btrim(x, F.lit(WHITESPACE)))

    def pick(lines: Column) -> Column:
        errors = F.filter(lines, lambda x: x.rlike(ERROR_LINE))
        filled = F.filter(lines, lambda x: x != "")
        return F.coalesce(F.try_element_at(errors, F.lit(-1)), F.try_element_at(filled, F.lit(-1)),
                          F.lit(NO_ERROR_TEXT))

    line = bind(lines, pick)
    return line if length is None else truncate(line, length)
