"""Template residue, filler text, and error or script notices in place of content.

Unfilled placeholders are found by one grammar per delimiter. Code blocks are left out. A placeholder in a
sentence that speaks about templates, or right after one, counts only if the text is dense with such, and a
mark that real texts use too (lower-case words in brackets) only if its sentence holds several. Filler is found by its wording, error pages and notices by their wording and by how little else the text
holds. A first vectorised pass lets only texts through that can hold a sign of some kind; the grammars
themselves are expressions of the engine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread

#: A placeholder per kind of delimiter.
PLACEHOLDERS = {
    "double braces": r"\{\{[#/^>!&]?\s*[\p{L}_][^{}\n]{0,60}\}\}",
    "single braces": r"(?<![\p{L}\p{N}_\\{])\$?\{[\p{L}_][\p{L}\p{N}_.]{0,40}\}(?!\})",
    "numbered braces": r"(?<![\p{L}\p{N}_\\{])\{\d{1,2}\}(?!\})[^{}\n]{0,80}\{\d{1,2}\}",
    "template tags": r"\{%[^%\n]{1,80}%\}|<%[^%\n]{1,80}%>|<\?(?:=|php)[^?\n]{1,80}\?>",
    "dollars": r"\$\$[\p{L}_][\p{L}\p{N}_ ]{0,40}\$\$|(?<![\p{L}\p{N}$])\$[A-Z][A-Z_]{2,40}\$",
    "double angles": r"<<\s*[\p{L}_][\p{L}\p{N}_ ]{0,40}>>",
    "capital angles": r"<\p{Lu}[\p{Lu}_]+(?:[ _]\p{Lu}[\p{Lu}_]*){0,5}>",
    "insert": r"(?i)[<\[({]\s*(?:insert|enter|your|add|fill in|replace|inserte|insérer|einfügen)\b[^<>\[\](){}\n]{0,60}[>\])}]",
    "escaped angles": r"&lt;[\p{L}_][\p{L}\p{N}_ ]{0,40}&gt;",
    "double brackets": r"\[\[\s*[\p{L}_][\p{L}\p{N}_ ]{0,40}\]\]",
    "capital brackets": r"\[\p{Lu}[\p{Lu}_]+(?:[ _]\p{Lu}[\p{Lu}_]*){0,5}\]",
    "format fields": r"%\([\p{L}_][\p{L}\p{N}_]{0,40}\)[sdifr]",
    "percents": r"(?<![\p{L}\p{N}%])%[\p{L}_][\p{L}_]{1,40}%(?![\p{L}\p{N}])",
    "at signs": r"@@[\p{L}_][\p{L}\p{N}_ ]{0,40}@@|(?<![\p{L}\p{N}@.])@[A-Z][A-Z_]{2,40}@",
    "hashes": r"(?<![\p{L}\p{N}#])#{1,3}\p{Lu}[\p{Lu}_]+(?:[ _]\p{Lu}[\p{Lu}_]*){0,5}#{1,3}(?![\p{L}\p{N}#])",
    "tildes": r"(?<![\p{L}\p{N}~])~\p{Lu}[\p{Lu}_]+(?:[ _]\p{Lu}[\p{Lu}_]*){0,5}~(?![\p{L}\p{N}~])",
    "underscores": r"(?<![\p{L}\p{N}_])__\p{Lu}[\p{Lu}_]*__(?![\p{L}\p{N}_])|_{5,}",
    "double parentheses": r"\(\(\s*\p{Lu}[\p{Lu}_]+(?:[ _]\p{Lu}[\p{Lu}_]*){0,5}\s*\)\)",
    "crosses": r"(?<![\p{L}\p{N}])X{2,}/X{2,}/X{2,}|(?<![\p{L}\p{N}])X{4,}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}])X{3,}\.X{2,}",
    "your here": r"\bYOUR (?:[A-Z]+ ){1,4}HERE\b",
    "empty values": r"(?i)[:=] ?(?:undefined|NaN|null|\[object object\])(?=[\s.,;]|$)|\b(?:of|at|in|on|for|from|by|to|with|near|the|a|an|de|del|en|por|para|con|los|las|el|la|du|des|le|les|von|bei|der|die|das|dem) (?:undefined|NaN|null)\b(?! (?:hypothes|value|set|model|space|distribut|result|island|string|pointer|and void|behaviou?r|term|symbol|variable|function|quantit|reference|operation))|\b(?:undefined|NaN|null) (?:ft|feet|mm|cm|m|in|mg/l|us/cm|gallons|days|minutes|visits|readings|pies|pieds|fuß|minutos|jours|tage)\b|\bfrom (?:undefined|null|nan) to\b|\[object Object\]|\bInvalid Date\b",
}
#: Fixed value: a mark that is a placeholder only in company; editors' marks are none.
WEAK = r"\[(?!(?:sic|ed|eds|note|unclear|illegible|emphasis added|translation|omitted|inaudible)\])\p{Ll}[\p{Ll} ]{2,40}\](?!\()"
#: Talk about placeholders, in whose sentence, and right after which, one placeholder is no residue.
TALK = r"(?i)placeholder|template|syntax|stands for|is written|are written|code book|the export|filled before|merge field|e\.g\. |for example|such as|literally|variable named"
CODE = r"(?s)```.*?```|~~~.*?~~~|<pre\b.*?</pre>|<code\b.*?</code>|`[^`\n]{1,200}`"
#: The words of filler Latin, and filler phrases that stand as a sentence of their own.
LATIN = r"(?:lorem|ipsum|dolor|dolore|amet|consectetur|adipiscing|elit|eiusmod|tempor|incididunt|labore|magna|aliqua|veniam|nostrud|sed|do|sit|ut|et|ei)"
FILLER = {
    "latin": rf"(?i)\b(?:lorem ipsum|{LATIN})(?:[ ,.]+{LATIN}){{3,}}\b",
    "crosses": r"(?i)(?<![\p{L}\p{N}])x{3,}(?: +x{3,})+",
    "repeated": r"(?i)\b(?<unit>(?:dummy|filler|sample|placeholder|fake|texto de|texte de|faux|platzhalter|blind) ?(?:text|relleno|remplissage|texte)[^.!?\n]{0,30}?)(?:[ .,]+\k<unit>){2,}",
    "keys": r"(?i)\b(?:blah[ ,]+){2,}|\b(?:asdf|qwerty)(?:[ ,]+(?:asdf|qwerty|jkl))+|\bfoo bar\b|\b(?:n/a[ ,.]+){2,}n/a|\b(?:test[ ,]+){3,}",
    "phrase": (
        r"(?i)(?:^|[.!?\n]\s*)(?:(?:insert|sample|dummy|your|placeholder|filler) (?:text|title|caption|image|name|content)\b[^.!?\n]{0,30}|(?:title|text|content|name|caption) goes here|"
        r"replace (?:this|with)\b[^.!?\n]{0,40}|edit me|type something|type here|content coming soon|coming soon|to be written|description to be added|to be added|placeholder for (?:figure|table|text|image|map)|"
        r"(?:this (?:section|page) is )?under construction|blindtext|texto de ejemplo|aquí va el texto|texte d'exemple|votre texte ici|sustituya (?:este|esta)\b[^.!?\n]{0,60}|remplacez ce\b[^.!?\n]{0,60}|beispieltext|hier steht\b[^.!?\n]{0,30}|click to (?:add|edit)\b[^.!?\n]{0,30}|tbd|todo|lorem ipsum)\s*(?:[.!?…]+|\n|$)"
    ),
}
#: Fields of a form that hold no value.
FIELD = r"(?im)^[\p{L} _/-]{1,30}:[ \t]*(?:tbd|todo|x{2,}|n/?a|\.{2,}|-+|to come|tba|none yet|pending|\?+|fill in|_+)?[ \t]*$"
#: Wording of error pages, denials, outages, failure traces, loading and script notices; each
#: sentence that holds one counts as notice as a whole.
NOTICES = (
    r"(?i)^\W*http(?:/\d\.\d)?(?: status)? ?[:\-]? ?[45]\d\d\b|^\W*(?:error|fehler|erreur|código|code|estado)(?: code)?[ :#]*[45]\d\d\b|^\W*[45]\d\d (?:not found|forbidden|bad gateway|bad request|unauthorized|gone|service unavailable|internal server error|gateway time-?out|too many requests|request time-?out)\b|"
    r"internal server error|error interno del servidor|erreur interne du serveur|interner serverfehler|access (?:is |was )?denied|acceso denegado|accès refusé|zugriff verweigert|page (?:not found|introuvable|no encontrada)|página no encontrada|seite nicht gefunden|"
    r"does not exist or|may be broken|was not found on|is no longer available|could not be (?:produced|completed|loaded)|cannot be displayed|request has been blocked|we cannot find that|you are not authorized|do not have permission|no tiene permiso|keine berechtigung|pas l'autorisation|"
    r"session has expired|sesión ha caducado|session a expiré|sitzung ist abgelaufen|log in again|login required|sign in to|iniciar sesión|inicie sesión|vuelva a iniciar|enter user ?name and password|please log in|anmeldung erforderlich|"
    r"down for (?:scheduled )?maintenance|due to maintenance|por mantenimiento|wegen wartung|pour maintenance|temporarily unavailable|servicio no disponible|"
    r"javascript (?:is (?:disabled|required|off)|must be|pour|en su|benötigt)|(?:enable|activer|aktivieren sie|active|activate|switch on|turn on|allow|requires|support) (?:javascript|scripts|cookies)|bitte aktivieren|"
    r"script blocker|scripting has to be|browser that runs scripts|without scripts enabled|scripts may be blocked|no backend is available|upstream service|unexpected condition was|contact the system administrator|server encountered|server did not respond|something went wrong|intente más tarde|checking your browser|process is automatic|exceeded the rate limit|retry after \d|too many requests|no rows returned|contact the help ?desk|no pudo completarse|cannot complete your request|browser does not support|try again (?:later|in a few)|"
    r"traceback \(most recent call last\)|file \"[^\"\n]+\", line \d+|^\W*[a-z]\w*(?:error|exception)\b:? ?[^\n]{0,80}$|\bjava\.\w+\.|\bat [\w.$]+\([\w]+\.\w+:\d+\)|^\W*exception in \w|ora-\d{2,}|err_[a-z]+_|ssl handshake failed|connection failed|query timed out|connect(?:ion)? (?:timeout|timed out|refused|reset)|^\W*proxy error|^\W*runtime error|"
    r"^\W*(?:loading|cargando|chargement|wird geladen)\b|please wait|\{\s*\"error\"\s*:|enable them to continue|sorry about that|^\W*oops|^\W*(?:error|fehler|erreur) ?\d*\W*$"
)
#: What every placeholder begins with, or code blocks that may hide its beginning.
MAY_MARK = (
    r"`|~~~|<(?:pre|code)|\{[\p{L}\p{N}_{%]|<[<%?\p{Lu}]|&lt;|\[[\[\p{Lu}]|[<\[({]\s*(?i:insert|enter|your|add|fill in|replace|inserte|insérer|einfügen)|"
    r"\$[$A-Z{]|%[\p{L}_(]|@[@A-Z]|#\p{Lu}|~\p{Lu}|__|\(\(|XX|YOUR|(?i:undefined|nan|null|invalid date|\[object)"
)
#: What stands around any page.
CHROME = (
    r"(?im)\b(?:skip to main content|back to search|terms of use|cookie settings|privacy(?: policy)?|contact(?: us)?|home|maps?|wells?|inicio|mapa|pozos|menu|search|log ?in|nginx|request id:? *[\w-]+|reference number *[\w-]+|\(code [\w-]+\)|time: *\d+ ?ms|código \d+|code \d+)\b|[|\-–•·]"
)


def _letters(x: Column) -> Column:
    """How many letters and digits a text has."""
    return F.length(F.regexp_replace(x, r"[^\p{L}\p{N}]+", ""))


def _one(patterns: dict[str, str]) -> str:
    return "|".join(f"(?:{p})" if not p.startswith("(?i)") else f"(?i:{p[4:]})" for p in patterns.values())


def _gate(*patterns: str) -> str:
    """A pattern that the whole text matches wherever a grammar matches it or a part of it: without anchors, word ends and looks around."""
    out = []
    for p in patterns:
        p = re.sub(r"\(\?<?[!=][^()]*\)", "", p).replace(r"^\W*", "").replace(r"\b", "")
        p = re.sub(r"\[\^[^\]]*\]\{0,\d+\}\??", r"[^\\n]*", p)
        p = re.sub(r"(?<=[*}\])])\$(?=\||$)", "", p)
        p = re.sub(r"\(\?<unit>(.*?)\)\(\?:\[ \.,\]\+\\k<unit>\)\{2,\}", r"(?:\1)", p)
        out.append(f"(?:{p})" if not p.startswith("(?i)") else f"(?i:{p[4:]})")
    return "|".join(out)


def gates() -> dict[str, str]:
    """Per kind of sign, a pattern for a linear-time engine that every text with such a sign matches. They follow from the grammars."""
    return {"may_mark": MAY_MARK, "may_weak": r"\[\p{Ll}", "may_filler": _gate(*FILLER.values()), "may_notice": _gate(NOTICES), "may_fields": "(?i)" + FIELD[FIELD.index(":") :].removesuffix("$") + r"(?:[\n\r\x{85}\x{2028}\x{2029}]|$)"}


def likely(rows: DataFrame) -> DataFrame:
    """The rows whose text may hold a sign of some kind, with a flag per kind: one vectorised pass over each batch of texts."""
    patterns = gates()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            flags = [pc.match_substring_regex(text, p) for p in patterns.values()]
            some = flags[0]
            for f in flags[1:]:
                some = pc.or_(some, f)
            yield pa.RecordBatch.from_arrays([*batch.columns, *flags], [*batch.schema.names, *patterns]).filter(some)

    kinds = T.StructType([*rows.schema.fields, *[T.StructField(k, T.BooleanType()) for k in patterns]])
    return rows.mapInArrow(run, kinds)


def signs(rows: DataFrame, several: int = 2) -> DataFrame:
    """Adds to ``text`` what it holds: placeholders, talked_about, words, filler, blank_fields, notice, rest, size.

    The grammars run on the texts whose flag (``likely``) says that they can match. What several tests share is
    projected before, so that it is computed once.
    """
    text = F.col("text")
    body = F.regexp_replace(text, CODE, " ")
    either = _one(PLACEHOLDERS)
    parts = F.split(text, r"(?<=[.!?…])\s+|\n+|\s[|\-–]\s")
    sentences = F.split(body, r"(?<=[.!?])\s+|\n+")
    rows = rows.withColumns({
        "_strong": F.when(F.col("may_mark"), F.regexp_count(body, F.lit(either))).otherwise(0),
        "_weak": F.when(F.col("may_weak"), F.regexp_count(body, F.lit(WEAK))).otherwise(0),
        "_parts": F.when(F.col("may_notice"), parts),
    })
    marks = F.transform(sentences, lambda s: F.struct(F.regexp_count(s, F.lit(either)).alias("strong"), F.regexp_count(s, F.lit(WEAK)).alias("weak"), s.rlike(TALK).alias("talk")))
    rows = rows.withColumns({
        "_marks": F.when((F.col("_strong") > 0) | (F.col("_weak") > 1), marks),
        "_plain": F.filter("_parts", lambda s: ~s.rlike(NOTICES)),
    })
    # the window of a sentence is itself and the one before it
    about = lambda x, i: x["talk"] | F.coalesce(F.get("_marks", i - 1)["talk"], F.lit(False))
    windows = F.transform("_marks", lambda x, i: F.struct(
        F.when(about(x, i), x["strong"]).otherwise(0).alias("talked"),
        F.when(~about(x, i) & (x["weak"] >= several), x["weak"]).otherwise(0).alias("close"),
    ))
    total = lambda name: F.coalesce(F.aggregate("_windows", F.lit(0), lambda n, w: n + w[name]), F.lit(0))
    rows = rows.withColumn("_windows", windows)
    fields, lines = F.regexp_count(text, F.lit(FIELD)), F.regexp_count(text, F.lit(r"(?m)^[^\n]*\S"))
    notice = F.coalesce(F.size("_plain") < F.size("_parts"), F.lit(False))
    return rows.withColumns({
        "placeholders": F.col("_strong") + total("close"),
        "talked_about": total("talked"),
        "words": F.when(F.col("_marks").isNotNull(), F.regexp_count(body, F.lit(r"[\p{L}\p{N}]+"))).otherwise(0),
        "filler": F.col("may_filler") & text.rlike(_one(FILLER)),
        "blank_fields": F.col("may_fields") & (fields >= 2) & (fields * 2 > lines),
        "notice": notice,
        "rest": F.when(notice, _letters(F.regexp_replace(F.array_join("_plain", " "), CHROME, " "))).otherwise(0),
        "size": F.when(notice, _letters(text)).otherwise(0),
    })


def residue(documents: DataFrame, key: str = "doc_id", text: str = "text", dense: float = 0.1, several: int = 2, rest_share: float = 0.4, rest_letters: int = 25) -> DataFrame:
    """(key, reason) of texts with leftovers in place of content; reason is the first of placeholder, filler, notice.

    A text has a placeholder if one stands outside sentences that speak of templates (and those after
    them), or if the ones inside make up at least ``dense`` of its words; marks that real texts use too count
    where a sentence has ``several``. It is a notice if, without the notice's wording and page furniture, at most
    ``rest_share`` of its letters or ``rest_letters`` letters are left. Null, empty and blank texts give no
    row. Whole texts are read, of any length; repeated rows each give a row, null keys too; other columns
    are ignored; an empty table gives an empty result.
    """
    rows = spread(documents.select(F.col(key).alias("key"), F.col(text).alias("text"))).where(F.col("text").isNotNull() & F.col("text").rlike(r"\S"))
    found = F.struct("placeholders", "talked_about", "words", "filler", "blank_fields", "notice", "rest", "size")

    def reason(x: Column) -> Column:
        return (
            F.when((x["placeholders"] > x["talked_about"]) | (x["talked_about"] > 0) & (x["talked_about"] >= dense * x["words"]), "placeholder")
            .when(x["filler"] | x["blank_fields"], "filler")
            .when(x["notice"] & ((x["rest"] <= rest_share * x["size"]) | (x["rest"] <= rest_letters)), "notice")
        )

    # a generator keeps the optimizer from copying the tests into the filter on their outcome
    reasons = F.filter(F.transform(F.array(found), reason), lambda r: r.isNotNull())
    return signs(likely(rows), several).select(F.col("key").alias(key), F.explode(reasons).alias("reason"))


def clean(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without leftovers. Rows with a null key are judged like any other."""
    rows = documents.withColumn("_judged", F.monotonically_increasing_id())
    bad = residue(rows, "_judged", text)
    return rows.join(bad.select("_judged"), "_judged", "left_anti").drop("_judged")
