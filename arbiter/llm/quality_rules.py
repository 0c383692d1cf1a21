"""Line-first cleaning: rules per line, then rejection of documents that lose too much text.

Only DataFrame functions run, row by row; no shuffle. A line fails by

* punctuation: over a tenth of its visible characters are symbols, or double exclamation or question
  marks come more often than every fifth word;
* navigation: separators stand alone among its words, three or more of them or one to at most five words (a row of
  links); or it is one of at least four lines in a row of up to three words that start with a capital and have no closing
  mark (a column of links); or the whole line is a menu word;
* boilerplate: of three words or more, most letters are capitals, with more capitals than words; or it is a line of at most
  30 words with a phrase of site furniture (cookies, copyright, scripts, subscriptions). Longer lines are prose that
  may speak of such things.

Rows and columns of links and capitals are seen by their form, whatever the language; menu words and furniture are listed
in the four languages of the supplied texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbiter.llm.common import WHITE, WORD

# The characters counted as symbols, separators, marks that close a line, menu words, and phrases of
# site furniture, in English, German, French and Spanish.
SYMBOLS = "#*$%&|<>"
SEPARATOR = "[|>»›•·/]"
CLOSED = r"[.!?…:;,)\]\x22\x27”“»][\x20\x09-\x0D]*\z"
CAPITAL = r"^[\x20\x09-\x0D]*\p{Lu}"
MENU = (r"(?i)^[\x20\x09-\x0D]*(home|menu|login|log in|sign in|sign up|register|contact|contact us|about|about us|search|next|"
        r"previous|back to top|read more|share|tweet|sitemap|faq|"
        r"startseite|anmelden|abmelden|registrieren|kontakt|impressum|suche|weiter|nach oben|weiterlesen|teilen|"
        r"accueil|connexion|se connecter|inscription|nous contacter|rechercher|suivant|haut de page|lire la suite|partager|plan du site|"
        r"inicio|iniciar sesi[oóÓ]n|registrarse|contacto|buscar|siguiente|volver arriba|leer m[aáÁ]s|compartir|mapa del sitio"
        r")[\x20\x09-\x0D]*\z")
FURNITURE = (r"(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie policy|uses cookies|"
             r"accept cookies|enable javascript|javascript is disabled|subscribe to our|sign up for our|"
             r"click here|lorem ipsum|follow us on|skip to (main )?content|"
             r"alle rechte vorbehalten|nutzungsbedingungen|verwendet cookies|cookies akzeptieren|javascript aktivieren|"
             r"newsletter abonnieren|klicken sie hier|folgen sie uns|zum inhalt springen|"
             r"tous droits r[eéÉ]serv[eéÉ]s|conditions d.utilisation|politique de confidentialit|utilise des cookies|accepter les cookies|"
             r"activer javascript|cliquez ici|suivez-nous|aller au contenu|"
             r"todos los derechos reservados|condiciones de uso|pol[iíÍ]tica de (privacidad|cookies)|utiliza cookies|aceptar (las )?cookies|"
             r"habilitar javascript|haga clic aqu|s[iíÍ]guenos en|saltar al contenido)")
#: A furniture phrase counts in lines of at most so many words, a menu word in lines of at most so many characters.
FURNITURE_WORDS, MENU_CHARS = 30, 40
#: A column of links: so many lines in a row, of at most so many words each.
COLUMN_LINES, COLUMN_WORDS = 4, 3


def _symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, SYMBOLS, ""))


def _visible(text: Column) -> Column:
    return F.length(F.translate(text, WHITE, ""))


def line_fails(line: Column, words: Column) -> Column:
    """Whether one line, of so many ``words``, fails a rule by itself; lines without a word never do."""
    visible = _visible(line)
    punctuation = (_symbols(line) * 10 > visible) | (F.regexp_count(line, F.lit(r"[!?]{2,}")) * 5 > words)
    separators = F.regexp_count(line, F.lit(rf"(?<![^\x20\x09-\x0D]){SEPARATOR}(?![^\x20\x09-\x0D])"))
    row = separators * 5 >= F.least(words, F.lit(15))  # three or more, or one to at most five words
    menu = (F.length(line) <= MENU_CHARS) & line.rlike(MENU)
    capitals = F.regexp_count(line, F.lit(r"\p{Lu}"))
    shouted = (words >= 3) & (capitals > words) & (capitals > F.regexp_count(line, F.lit(r"\p{Ll}")))
    furniture = (words <= FURNITURE_WORDS) & line.rlike(FURNITURE)
    return (words > 0) & (punctuation | row | menu | shouted | furniture)


def link_like(line: Column, words: Column) -> Column:
    """Whether a line, of so many ``words``, could be an entry of a column of links."""
    return (words <= COLUMN_WORDS) & line.rlike(CAPITAL) & ~line.rlike(CLOSED)


def _in_column(starts: Column, at: Column) -> Column:
    """Whether one of the columns of links that start at the places marked in ``starts`` covers line ``at``."""
    covered = F.get(starts, at)
    for back in range(1, COLUMN_LINES):
        covered = covered | F.coalesce(F.get(starts, at - back), F.lit(False))
    return covered


def _bit(h: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))


def _repeated_words(step: DataFrame, windows: str, out: str) -> DataFrame:
    """Adds ``out``: words covered by 3-word windows that the text holds twice or more.

    ``windows`` holds the windows' 64-bit hashes in text order. Equal neighbours of the sorted
    hashes are the repeated ones; a 64-bit mask of them picks the positions that may repeat; those are
    sorted by hash and position, and the ones with an equal neighbour count. Every step is linear or
    n log n in the text.
    """
    step = step.withColumn("_ordered", F.sort_array(windows))
    twice = F.filter("_ordered", lambda h, i: F.coalesce(h == F.get("_ordered", i + 1), F.lit(False)))
    step = step.withColumn("_mask", F.aggregate(twice, F.lit(0).cast("long"), lambda acc, h: acc.bitwiseOR(_bit(h))))
    placed = F.filter(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))),
                      lambda x: F.col("_mask").bitwiseAND(_bit(x["h"])) != 0)
    step = step.withColumn("_maybe", F.when(F.col("_mask") != 0, F.sort_array(placed)))
    beside = lambda x, i: F.coalesce(x["h"] == F.get("_maybe", i)["h"], F.lit(False))
    step = step.withColumn("_again", F.filter("_maybe", lambda x, i: beside(x, i + 1) | beside(x, i - 1)))
    covered = F.array_distinct(F.flatten(F.transform("_again", lambda x: F.sequence(x["i"], x["i"] + 2))))
    return step.withColumn(out, F.coalesce(F.size(covered), F.lit(0)).cast("long")).drop(
        "_ordered", "_mask", "_maybe", "_again")


def judged(docs: DataFrame, text_col: str = "text", max_lost: float = 0.3) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lost_words,
    clean_text and kept.

    A document is rejected when its base fails (under 50 words, or over half of its words lie in
    repeated 3-word windows) or when the failed lines hold over ``max_lost`` of its words. Null
    and empty texts have no words and fail the base. ``clean_text`` is the text without failed
    lines (null for a null text). Rows repeat as they came; ties can't arise; an empty table gives
    no rows; input columns named like an added one are replaced. Windows are compared by 64-bit hash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lost_words",
             "clean_text", "kept"]
    base = docs.drop(*[c for c in added if c != text_col])
    words, lines = F.col("_words"), F.col("_lines")
    step = base.withColumns({"_words": F.regexp_extract_all(text, F.lit(WORD), 0), "_lines": F.split(text, "\n", -1)})
    step = step.withColumn("_windows", F.when(F.size(words) > 2, F.transform(
        F.slice(words, F.lit(1), F.size(words) - 2),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<long>")))
    step = _repeated_words(step, "_windows", "n_repeat_words")
    # a line's words are counted once: inside a lambda every mention would be evaluated anew
    step = step.withColumn("_counts", F.transform(lines, lambda x: F.regexp_count(x, F.lit(WORD))))
    count = lambda i: F.get("_counts", i)
    step = step.withColumn("_links", F.transform(lines, lambda x, i: link_like(x, count(i))))
    starts = F.transform("_links", lambda x, i: reduce(
        lambda all_, ahead: all_ & F.coalesce(F.get("_links", i + ahead), F.lit(False)), range(1, COLUMN_LINES), x))
    step = step.withColumn("_starts", starts)
    step = step.withColumn("_solid", F.filter(lines, lambda x, i: count(i) > 0))
    step = step.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": _visible(text).cast("long"),
        "n_symbols": _symbols(text).cast("long"),
        "n_dup_lines": (F.size("_solid") - F.size(F.array_distinct("_solid"))).cast("long"),
        "_fails": F.transform(lines, lambda x, i: line_fails(x, count(i)) | _in_column(F.col("_starts"), i))})
    step = step.withColumn("n_lost_words", F.aggregate(
        F.zip_with("_fails", "_counts", lambda bad, n: F.when(bad, n).otherwise(0)), F.lit(0).cast("long"), lambda total, n: total + n))
    kept_lines = F.filter(lines, lambda x, i: ~F.get("_fails", i))
    step = step.withColumn("clean_text", F.when(F.col(text_col).isNotNull(), F.array_join(kept_lines, "\n")))
    step = step.withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
    step = step.withColumn("kept", ~F.col("base_failed") & (F.col("n_lost_words") <= F.col("n_words") * F.lit(float(max_lost))))
    return step.drop("_words", "_lines", "_windows", "_counts", "_solid", "_fails", "_links", "_starts")


def clean(docs: DataFrame, text_col: str = "text", max_lost: float = 0.3) -> DataFrame:
    """The documents that stay, with failed lines removed from their text and the columns of ``docs``."""
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text_col).alias("text"))
    # The row number keeps the optimizer from pushing the filter below the steps, which would repeat each step
    # inside the next one's lambdas.
    made = judged(whole, "text", max_lost).withColumn("_row", F.monotonically_increasing_id()).filter("kept and _row >= 0")
    return made.select(*[F.col("clean_text").alias(c) if c == text_col else F.col("_doc").getField(c).alias(c) for c in docs.columns])
