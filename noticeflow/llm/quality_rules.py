"""Line-first cleaning: rules judge each line, failing lines go, a document that loses too much is rejected.

A line fails as
* symbols: at least SYMBOL_SHARE of its characters are among ``#*$%&|<>`` (from three such characters on);
* punctuation: at least PUNCT_SHARE of its characters are punctuation (from PUNCT_LEAST on), or it has LONG_WORDS words
  or more and no mark that ends or divides a sentence, in a text that has such marks elsewhere;
* navigation: its words stand between NAV_BARS separators such as ``|``, ``>`` or ``·``, or it is a breadcrumb of
  at most NAV_WORDS words whose parts are at most NAV_PART words long, or it is one of MENU_LINES lines or more that follow
  each other, of at most MENU_WORDS words and without a sentence end;
* shouting: at least SHOUT_WORDS words, most of its letters capital, and a repeated exclamation mark;
* boilerplate: it holds one of the BOILERPLATE phrases and is at most BOILERPLATE_WORDS words long.
Lines without a word are left as they are. A document is rejected if the failing
lines hold more than LOSS_SHARE of its word characters, or if a base rule fails.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from noticeflow.llm.common import WORD, map_text, nullable, small_batches

SYMBOLS = re.compile(r"[#*$%&|<>]")
SYMBOL_SHARE = 0.1
PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~\u00a1-\u00bf\u2010-\u205e\u2190-\u2bff\u3001-\u303f\uff01-\uff0f]")
PUNCT_LEAST, PUNCT_SHARE = 8, 0.3
LONG_WORDS, SENTENCE_MARK = 100, re.compile(r"[.!?:;,\u2026\u3001\u3002\uff01\uff0c\uff1f]")
SENTENCE_END = re.compile(r"[.!?:\u2026\u3002\uff01\uff1f][\"')\]\u00bb\u201d\u2019]*\s*$")
SEPARATORS = frozenset("| / \\ > >> \u00bb \u203a \u00b7 \u2022 \u2023 \u25aa \u2013 \u2014 :: ~ \u2192 \u25b8".split())
NAV_BARS, NAV_WORDS, NAV_PART = 3, 12, 3
MENU_LINES, MENU_WORDS = 4, 2
SHOUT_WORDS, SHOUT_SHARE = 5, 0.7
BOILERPLATE_WORDS = 30
LOSS_SHARE = 0.5
# Phrases of page furniture in English, German, French and Spanish.
BOILERPLATE = re.compile(
    r"(?i)all rights reserved|cookie (?:policy|settings)|accept (?:all )?cookies|privacy policy|terms of (?:use|service)"
    r"|subscribe to our newsletter|sign up for|click here|read more|share (?:this|on)|lorem ipsum|enable javascript"
    r"|skip to (?:main )?content|back to top"
    r"|alle rechte vorbehalten|cookie-?(?:richtlinie|einstellungen)|cookies? (?:akzeptieren|zulassen)|datenschutzerkl\u00e4rung"
    r"|nutzungsbedingungen|newsletter (?:abonnieren|anmelden|bestellen)|hier klicken|weiterlesen|mehr lesen|jetzt teilen"
    r"|zum (?:haupt)?inhalt springen|nach oben|javascript aktivieren"
    r"|tous droits r\u00e9serv\u00e9s|politique de (?:confidentialit\u00e9|cookies)|accepter (?:tous )?les cookies|param\u00e8tres des cookies"
    r"|conditions (?:d.utilisation|g\u00e9n\u00e9rales)|(?:inscrivez-vous|abonnez-vous) \u00e0 (?:notre|la) newsletter|cliquez ici|lire la suite"
    r"|en savoir plus|partager (?:sur|cet)|aller au contenu|haut de page|activer javascript"
    r"|todos los derechos reservados|pol\u00edtica de (?:privacidad|cookies)|aceptar (?:todas las |las )?cookies|configuraci\u00f3n de cookies"
    r"|t\u00e9rminos (?:de uso|y condiciones)|suscr\u00edbete a nuestro|haga clic aqu\u00ed|haz clic aqu\u00ed|leer m\u00e1s|compartir en"
    r"|saltar al contenido|volver arriba|activar javascript")


@dataclass
class Judged:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    base_failed: bool
    kept: bool
    n_lines: int
    n_bad_lines: int
    cleaned: str


def line_fails(line: str, words: list[str], marked: bool = True) -> bool:
    """Whether a line that has words breaks a rule; ``marked``: its text has sentence marks at all."""
    symbols = len(SYMBOLS.findall(line))
    if symbols >= 3 and symbols >= SYMBOL_SHARE * sum(map(len, words)):
        return True
    marks = len(PUNCTUATION.findall(line))
    if marks >= PUNCT_LEAST and marks >= PUNCT_SHARE * sum(map(len, words)):
        return True
    if marked and len(words) >= LONG_WORDS and not SENTENCE_MARK.search(line):
        return True
    if marks and is_menu(words):
        return True
    if "!!" in line and len(words) >= SHOUT_WORDS:
        letters = [c for c in line if c.isalpha()]
        if sum(c.isupper() for c in letters) > SHOUT_SHARE * len(letters):
            return True
    return len(words) <= BOILERPLATE_WORDS and BOILERPLATE.search(line) is not None


def is_menu(words: list[str]) -> bool:
    """Whether separators that stand alone cut the words into the entries of a menu or breadcrumb."""
    places = [n for n, word in enumerate(words) if word in SEPARATORS]
    if not places:
        return False
    entries = [z - a - 1 for a, z in zip([-1, *places], [*places, len(words)], strict=True)]
    if len(places) >= NAV_BARS:
        return words.count("|") >= NAV_BARS or sum(entries) <= 2 * NAV_PART * len(entries)
    return len(words) <= NAV_WORDS and max(entries) <= NAV_PART and min(entries) > 0


def column_menus(lines: list[tuple[str, int]]) -> set[int]:
    """Places of lines (text, words) that form a menu of one entry a line; lines without a word do not end one."""
    found, run = set(), []
    for place, (line, count) in enumerate([*lines, (".", MENU_WORDS + 1)]):
        if 0 < count <= MENU_WORDS and not SENTENCE_END.search(line):
            run.append(place)
        elif count:
            if len(run) >= MENU_LINES:
                found.update(run)
            run = []
    return found


def repeated(words: list[str], width: int = 5) -> int:
    """Words inside windows of ``width`` words that the text has twice or more."""
    windows = list(zip(*[words[i:] for i in range(width)], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    count, covered = 0, 0  # words before `covered` are counted
    for i, window in enumerate(windows):
        if seen[window] > 1:
            count += i + width - max(covered, i)
            covered = i + width
    return count


def judge(text: str) -> Judged:
    """All measures of one whole text."""
    words, good, earlier, duplicates = [], [], set(), 0
    lines, bad, lost = text.split("\n"), 0, 0
    found = [WORD.findall(line) for line in lines]
    marked = SENTENCE_MARK.search(text) is not None
    menus = column_menus([(line, len(own)) for line, own in zip(lines, found, strict=True)])
    for place, (line, own) in enumerate(zip(lines, found, strict=True)):
        if not own:
            good.append(line)
            continue
        words += own
        if line in earlier:
            duplicates += 1
        earlier.add(line)
        if place in menus or line_fails(line, own, marked):
            bad += 1
            lost += sum(map(len, own))
        else:
            good.append(line)
    chars, again = sum(map(len, words)), repeated(words)
    failed = len(words) < 10 or 100 * again > 20 * len(words)
    return Judged(len(words), chars, len(SYMBOLS.findall(text)), duplicates, again, failed,
                  not failed and lost <= LOSS_SHARE * chars, len(lines), bad, "\n".join(good))


MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
            "base_failed boolean, kept boolean, n_lines bigint, n_bad_lines bigint")


def quality_measures(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, the measures and the verdict of every row.

    A NULL text counts as empty: no words, so it fails. Rows are judged each on
    its own, so repeated rows and NULL keys keep their row; other columns are
    left out; an empty table gives no rows. No shuffle; memory is bounded by the batch and the longest text.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = [f.split()[0] for f in MEASURES.split(", ")]

    def make(batch: pa.RecordBatch) -> dict:
        found = [judge(t or "") for t in batch.column("_text").to_pylist()]
        return {"_key": batch.column("_key"), **{n: [getattr(f, n) for f in found] for n in names}}

    rows = docs.selectExpr(f"`{key}` AS _key", f"`{text}` AS _text")
    return map_text(rows, "_text", f"_key {kind}, {MEASURES}", make).withColumnRenamed("_key", key)


def clean(docs: DataFrame, text: str = "text", chars: str = "n_chars") -> DataFrame:
    """The kept rows, all columns, without their failing lines; the character count follows the text where a line went.

    NULL, empty and very short texts fail the base rules and go. Each row is judged on its own and whole: repeated rows,
    NULL keys and columns of any name stay as they are; an empty table gives no rows.
    """
    schema, names = docs.schema, docs.columns

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in small_batches(batches, text):
            found = [judge(t or "") for t in batch.column(text).to_pylist()]
            kept = batch.filter(pa.array([f.kept for f in found], pa.bool_()))
            rest = [f for f in found if f.kept]
            columns = []
            for name, field in zip(names, arrow, strict=True):
                if name == text:
                    columns.append(pa.array([f.cleaned for f in rest], field.type))
                elif name == chars:
                    old = kept.column(name).to_pylist()
                    columns.append(pa.array([len(f.cleaned) if f.n_bad_lines else o for f, o in
                                             zip(rest, old, strict=True)]).cast(field.type))
                else:
                    columns.append(kept.column(name).cast(field.type))
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return docs.mapInArrow(run, nullable(schema))
