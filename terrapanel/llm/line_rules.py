"""Quality rules, line first: failing lines go, then documents that lost too much text.

DataFrame functions only.  Each line is judged alone: its end mark, navigation separators, links, boilerplate
phrases, symbols and capitals.  A document stays if it passes the base rules and the lines that stay
hold at least half of its word characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = r"[\\x20\\x09-\\x0D]+"
#: A line without one of these at its end needs LONG_LINE words to stay.
END_MARK = r"[.!?:;…][\"\'”’»)\\]]*$"
LONG_LINE = 12
#: Only shorter lines are looked through for boilerplate phrases.
SHORT_LINE = 40
SEPARATORS = "|»›•·"
SYMBOLS = "#*$%&|<>"
#: Phrases of page furniture in English, German, Spanish and French.
PHRASES = (
    "cookie policy", "privacy policy", "terms of (use|service)", "all rights reserved", "javascript", "lorem ipsum", "click here", "sign (in|up) (to|for)", "log ?in to", "subscribe to", "read more",
    "skip to (main )?content", "powered by", "share (on|this)",
    "datenschutz", "impressum", "alle rechte vorbehalten", "nutzungsbedingungen", "hier klicken", "weiterlesen", "mehr erfahren", "zum inhalt springen", "newsletter abonnieren", "jetzt anmelden",
    "política de (privacidad|cookies)", "aviso legal", "todos los derechos reservados", "términos (de uso|y condiciones)", "haga clic", "leer más", "iniciar sesión", "suscríbete", "saltar al contenido",
    "politique de confidentialité", "mentions légales", "tous droits réservés", "conditions d.utilisation", "cliquez ici", "lire la suite", "se connecter", "abonnez-vous", "aller au contenu",
)
BOILERPLATE = "(" + "|".join(PHRASES) + ")"
#: Words that are links; a line with a third of them is a list of links.
LINK = r"^(https?://|www[.])"


def line_fails(x: str) -> str:
    """SQL for the rules on a line, a struct of its text ``line``, its ``words`` and them joined, ``solid``."""
    return f"""
        (size({x}.words) < {LONG_LINE} AND NOT rlike(right({x}.solid, 4), '{END_MARK}'))
        OR 3 * regexp_count({x}.solid, '[{SEPARATORS}]') >= size({x}.words)
        OR ((contains({x}.line, '://') OR contains({x}.line, 'www.')) AND 3 * size(filter({x}.words, w -> rlike(w, '{LINK}'))) >= size({x}.words))
        OR 8 * regexp_count({x}.solid, '[{SYMBOLS}]') >= length({x}.solid)
        OR (length({x}.solid) >= 8 AND 2 * regexp_count({x}.solid, '\\\\p{{Lu}}') >= length({x}.solid))
        OR (size({x}.words) < {SHORT_LINE} AND rlike(lower({x}.line), '{BOILERPLATE}'))
    """


def clean_lines(docs: DataFrame) -> DataFrame:
    """The base measures, the verdict and the cleaned text of each row.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not looked at.  Result: ``doc_id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, kept_text``; ``kept_text``
    holds the lines that passed, whatever the verdict.

    Null, empty and blank texts count as no words: they fail the base rules.  Rows with a null
    ``doc_id`` and repeated rows are judged like any other; every row gives a row.
    """
    text = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    windows = "if(size(words) < 5, array(), transform(sequence(0, size(words) - 5), i -> xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4])))"
    parts = (
        text.selectExpr("doc_id", f"transform(split(text, '\\n'), l -> struct(l AS line, filter(split(l, '{SPACE}'), w -> w <> '') AS words)) AS lines")
        .selectExpr("doc_id", "transform(filter(lines, x -> size(x.words) > 0), x -> struct(x.line, x.words, array_join(x.words, '') AS solid)) AS lines")
        .selectExpr("doc_id", "lines", "flatten(lines.words) AS words", f"filter(lines, x -> NOT ({line_fails('x')})) AS good")
        .selectExpr(
            "doc_id",
            "size(words) AS n_words",
            "aggregate(lines.solid, 0L, (a, x) -> a + length(x)) AS word_chars",
            "aggregate(good.solid, 0L, (a, x) -> a + length(x)) AS kept_chars",
            f"aggregate(lines.solid, 0L, (a, x) -> a + regexp_count(x, '[{SYMBOLS}]')) AS n_symbols",
            "size(lines) - size(array_distinct(lines.line)) AS n_dup_lines",
            "array_join(good.line, '\\n') AS kept_text",
            f"{windows} AS windows",
        )
    )
    # Only texts with a repeated window sort their windows.
    parts = parts.selectExpr("*", "if(size(array_distinct(windows)) < size(windows), sort_array(transform(windows, (h, i) -> struct(h AS h, i AS i))), array()) AS placed").drop("windows")
    parts = parts.selectExpr("*", "sort_array(transform(filter(placed, (x, k) -> x.h = get(placed, k - 1).h OR x.h = get(placed, k + 1).h), x -> x.i)) AS repeated").drop("placed")
    parts = parts.selectExpr("*", "aggregate(transform(repeated, (p, k) -> least(5, coalesce(get(repeated, k + 1), p + 5) - p)), 0, (a, x) -> a + x) AS n_repeat_words")
    base = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
    return parts.selectExpr(
        "doc_id",
        "CAST(n_words AS LONG) AS n_words",
        "word_chars",
        "n_symbols",
        "CAST(n_dup_lines AS LONG) AS n_dup_lines",
        "CAST(n_repeat_words AS LONG) AS n_repeat_words",
        f"{base} AS base_failed",
        f"(NOT {base} AND 2 * kept_chars >= word_chars) AS kept",
        "kept_text",
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op7: the rules over every document."""
    return clean_lines(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("kept_text")
