"""Text, number and identifier functions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of languages by ISO 639-2 code.
LANGUAGE_NAMES = {
    "eng": "English", "hin": "Hindi", "ben": "Bengali", "mar": "Marathi", "tel": "Telugu", "tam": "Tamil",
    "kan": "Kannada", "mal": "Malayalam", "guj": "Gujarati", "ori": "Odia", "pan": "Punjabi", "asm": "Assamese",
    "urd": "Urdu", "san": "Sanskrit", "nep": "Nepali", "kok": "Konkani", "mni": "Manipuri", "bod": "Bodo",
    "doi": "Dogri", "kas": "Kashmiri", "mai": "Maithili", "sat": "Santali", "snd": "Sindhi", "fre": "French",
    "ita": "Italian", "por": "Portuguese",
}


def _map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def squeeze(text: Column) -> Column:
    """White space of all kinds collapsed to single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, "(?U)\\s+", " "))


def legal_xml(text: Column, by: str = "") -> Column:
    """Without characters that XML 1.0 does not allow."""
    return F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\uFFFE\\uFFFF]", by)


def without_controls(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x00-\\x1F\\x7F]", "")


def slug(text: Column, space: str = "-") -> Column:
    """Lower case, white space and slashes replaced."""
    return F.regexp_replace(F.replace(F.lower(F.trim(text)), F.lit("/"), F.lit("_")), "\\s+", space)


def stem_of_path(url: Column) -> Column:
    """The last part of a path without its extension."""
    return F.regexp_replace(F.regexp_extract(F.regexp_replace(url, "[?#].*$", ""), "([^/]*)/?$", 1), "\\.[A-Za-z0-9]+$", "")


def file_name_of_url(url: Column, path: bool = True, query: bool = True) -> Column:
    """Path parts and query values joined by underscores."""
    parts = F.filter(F.split(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), "/"), lambda p: p != "")
    values = F.transform(
        F.filter(F.split(F.coalesce(F.parse_url(url, F.lit("QUERY")), F.lit("")), "&"), lambda p: p != ""),
        lambda p: F.element_at(F.split(p, "="), -1),
    )
    chosen = [x for x, on in ((parts, path), (values, query)) if on]
    return F.array_join(F.concat(*chosen) if len(chosen) > 1 else chosen[0], "_")


def fixed_url(url: Column) -> Column:
    """Spaces and other bytes outside the URL alphabet percent-encoded, + for spaces of the query.

    Escapes that are there stay as they are.
    """
    path, query = F.substring_index(url, "?", 1), F.regexp_extract(url, "(?s)\\?(.*)$", 1)

    def encoded(part, space):
        chars = F.split(part, "")
        one = F.transform(
            chars,
            lambda c: F.when(c.rlike("[A-Za-z0-9_.~/%:&=?#+,;@!$'()*-]"), c).when(c == " ", F.lit(space)).when(c == "", c)
            .otherwise(F.regexp_replace(F.hex(c.cast("binary")), "(..)", "%$1")),
        )
        return F.array_join(one, "")

    return F.concat(encoded(path, "%20"), F.when(F.contains(url, F.lit("?")), F.concat(F.lit("?"), encoded(query, "+"))).otherwise(""))


def identifier(relurl: Column, rule: Column, prefix: Column, date: Column, fields: dict[str, Column]) -> Column:
    """The archive identifier by the source's rule; null where the rule lacks what it needs.

    Rules: basic (rest of the url, dots for slashes), dated (date and last part), dated_number
    (date, gznum, gztype), cut (basic, at most 69 characters), number_series, book.
    """
    source = F.substring_index(relurl, "/", 1)
    rest = F.regexp_replace(F.regexp_extract(relurl, "^[^/]*/(.*)$", 1), "[',&:%\\s;()–]", "")
    basic = F.replace(rest, F.lit("/"), F.lit("."))
    day = F.date_format(date, "yyyy-MM-dd")
    dot = F.lit(".")
    tail = (
        F.when(rule == "dated", F.concat(day, dot, F.element_at(F.split(rest, "/"), -1)))
        .when(rule == "dated_number", F.concat(day, dot, fields["gznum"], dot, fields["gztype"]))
        .when(rule == "cut", F.left(basic, F.lit(69)))
        .when(rule == "number_series", F.concat(fields["gznum"], dot, fields["series"]))
        .when(rule == "book", fields["bookid"])
        .otherwise(basic)
    )
    return F.concat(F.coalesce(prefix, F.concat(F.lit("in.gazette."), source, dot)), tail)


def padded_page(page: Column, pages: Column) -> Column:
    """A page number with zeros up to the width of the page count, at most four; longer numbers stay."""
    width = F.least(F.length(pages.cast("string")), F.lit(4))
    text = page.cast("string")
    return F.concat(F.repeat(F.lit("0"), F.greatest(width - F.length(text), F.lit(0))), text)


def split_keywords(text: Column) -> Column:
    return F.regexp_replace(text, "([a-z])([A-Z])", "$1, $2")


def kind_of_title(title: Column) -> Column:
    """Extraordinary before Index before Supplement before Appendix, by what the title holds."""
    low = F.lower(title)
    out = F.when(F.contains(low, F.lit("extraordinary")), "Extraordinary")
    for word in ("Index", "Supplement", "Appendix"):
        out = out.when(F.contains(low, F.lit(word.lower())), word)
    return out


def split_parts(text: Column, names: list[str]) -> Column:
    """type/part/district as a struct; missing parts are null."""
    parts = F.split(text, "/")
    return F.struct(*[F.trim(F.try_element_at(parts, F.lit(i + 1))).alias(n) for i, n in enumerate(names)])


def _some(column: Column) -> Column:
    value = F.trim(column)
    return F.when(value != "", value)


def built_title(title: Column, subject: Column, source_title: Column, number: Column, part: Column, date: Column, year: Column) -> Column:
    """The title, else the subject, else the series with number, part and date or year."""
    parts = F.concat_ws(
        ", ", _some(source_title), F.concat(F.lit("No. "), _some(number)), F.concat(F.lit("Part "), _some(part)),
        F.coalesce(F.date_format(date, "dd MMMM yyyy"), year.cast("string")),
    )
    return F.coalesce(_some(title), _some(subject), parts)


def published_title(category: Column, date: Column, kind: Column, part: Column, number: Column) -> Column:
    """Category, date, kind, part and number; the word Part is added only where the part lacks it."""
    with_word = F.when(F.lower(part).rlike("\\bpart\\b"), part).otherwise(F.concat(F.lit("Part "), part))
    return F.concat_ws(", ", _some(category), F.date_format(date, "dd MMMM yyyy"), _some(kind), _some(with_word), F.concat(F.lit("Number "), _some(number)))


def description(fields: list[tuple[str, Column]], links: Column | None = None) -> Column:
    """Lines of 'Label: value' for the fields that have one, and links, joined by line breaks."""
    lines = [F.when(_some(v).isNotNull(), F.concat(F.lit(f"{label}: "), _some(v))) for label, v in fields]
    if links is not None:
        lines.append(F.when(F.size(links) > 0, F.array_join(F.transform(links, lambda u: F.concat(F.lit('<a href="'), escaped(u), F.lit('">'), escaped(u), F.lit("</a>"))), "<br/>")))
    return F.concat_ws("<br/>", *lines)


def listed(items: Column, labels: dict[str, str]) -> Column:
    """An array of structs as 'Label: v | Label: v', one item a line."""
    def one(item):
        return F.concat_ws(" | ", *[F.when(_some(item[k]).isNotNull(), F.concat(F.lit(f"{v}: "), _some(item[k]))) for k, v in labels.items()])

    return F.array_join(F.transform(items, one), "<br/>")


def indian_grouping(value: Column) -> Column:
    """12,34,567; '' for null, text without a number as it is."""
    text = value.cast("string")
    sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
    digits = F.ltrim(text, F.lit("-"))
    head, tail = F.left(digits, F.length(digits) - 3), F.right(digits, F.lit(3))
    grouped = F.reverse(F.regexp_replace(F.reverse(head), "([0-9]{2})", "$1,"))
    joined = F.concat(sign, F.ltrim(grouped, F.lit(",")), F.lit(","), tail)
    return F.when(value.isNull(), "").when(~text.rlike("^-?[0-9]+$") | (F.length(digits) <= 3), text).otherwise(joined)


def without(values: Column, item) -> Column:
    return F.array_remove(values, item)


def summary(text: Column, length: int = 320) -> Column:
    """At most so many characters, cut at a word, with an ellipsis if cut."""
    flat = squeeze(text)
    cut = F.substring(flat, 1, length)
    return F.when(F.length(flat) <= length, flat).otherwise(F.concat(F.regexp_replace(cut, " [^ ]*$", ""), F.lit("…")))


def truncated(text: Column, limit: int) -> Column:
    """(text, cut) with at most so many characters; 0 is no limit."""
    too_long = (F.length(text) > limit) if limit else F.lit(False)
    return F.struct(F.when(too_long, F.substring(text, 1, limit)).otherwise(text).alias("text"), too_long.alias("cut"))


def index_head(text: Column, limit: int) -> Column:
    """The first bytes of a text, cut between characters and at a space if one lies in the second half.

    The half is counted in characters of the cut text against the limit in bytes.
    """
    cut = F.regexp_replace(F.make_valid_utf8(F.substring(text.cast("binary"), 1, limit).cast("string")), "\\uFFFD+$", "")
    space = F.length(cut) - F.instr(F.reverse(cut), " ")
    at_space = F.contains(cut, F.lit(" ")) & (space > limit // 2)
    return F.when(F.octet_length(text) <= limit, text).when(at_space, F.left(cut, space.cast("int"))).otherwise(cut)


def digest(data: Column) -> Column:
    return F.sha2(data, 256)


def escaped(text: Column) -> Column:
    """HTML-escaped, quotes included."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def highlighted(text: Column, start: str = "\x02", stop: str = "\x03") -> Column:
    """Escaped text with the marks of a snippet as <mark>."""
    safe = escaped(F.coalesce(text, F.lit("")))
    return F.replace(F.replace(safe, F.lit(start), F.lit("<mark>")), F.lit(stop), F.lit("</mark>"))


def language_names(codes: Column) -> Column:
    return F.transform(codes, lambda c: F.coalesce(F.try_element_at(_map(LANGUAGE_NAMES), F.lower(c)), F.upper(c)))


def language_code(name: Column) -> Column:
    """ISO code of a language name in any case; its first three letters if the name is unknown."""
    back = {v.lower(): k for k, v in LANGUAGE_NAMES.items()}
    key = F.lower(F.trim(name))
    return F.coalesce(F.try_element_at(_map(back), key), F.left(key, F.lit(3)))


def scan_language(codes: Column, table: dict[str, str], default: str = "en") -> Column:
    """The first language of a source that the table maps to something but the default, else the default."""
    mapped = F.filter(F.transform(codes, lambda c: F.try_element_at(_map(table), c)), lambda c: c.isNotNull() & (c != default))
    return F.coalesce(F.try_element_at(mapped, F.lit(1)), F.lit(default))


def extension_of_type(mime: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(_map(table), F.lower(F.trim(F.substring_index(mime, ";", 1))))


#: The first bytes of files, in hex, and the extension they tell.
SIGNATURES = {"25504446": "pdf", "504B0304": "zip", "D0CF11E0": "doc", "7B5C727466": "rtf", "FFD8FF": "jpg", "89504E47": "png", "1F8B": "gz"}


def extension_of_content(content: Column) -> Column:
    head = F.hex(F.substring(content, 1, 8))
    out = None
    for signature, ext in SIGNATURES.items():
        test = F.startswith(head, F.lit(signature))
        out = F.when(test, ext) if out is None else out.when(test, ext)
    start = F.lower(F.ltrim(F.make_valid_utf8(F.substring(content, 1, 64).cast("string"))))
    return out.when(F.startswith(start, F.lit("<!doctype html")) | F.startswith(start, F.lit("<html")), "html").when(F.startswith(start, F.lit("<?xml")), "xml")


def none_to_null(text: Column) -> Column:
    return F.when(F.lower(F.trim(text)) != "none", text)


def decoded(payload: Column) -> Column:
    """The bytes of base64 text, a data: prefix allowed; null if it is not base64."""
    return F.try_to_binary(F.regexp_replace(payload, "^data:[^,]*,", ""), F.lit("base64"))


def decoded_text(data: Column) -> Column:
    """Bytes as UTF-8 if they are, else UTF-16 with a byte-order mark, else Latin-1."""
    as_text = data.cast("string")
    marked = F.hex(F.substring(data, 1, 2)).isin("FFFE", "FEFF")
    return F.when(F.is_valid_utf8(as_text), as_text).when(marked, F.decode(data, "UTF-16")).otherwise(F.decode(data, "ISO-8859-1"))


def sentence_end(text: Column) -> Column:
    """Ends like a sentence and not with a usual abbreviation or initial."""
    clean = F.rtrim(text)
    return F.coalesce(clean.rlike("[.?!:;][\"')\\]]*$") & ~clean.rlike("(?i)(?:^|[\\s(])(?:no|nos|dr|mr|mrs|shri|smt|sec|art|vs|viz|[a-z])\\.$"), F.lit(False))


def heading_tag(text: Column) -> Column:
    """h2 for chapters and parts, h3 for capitals, h4 for numbered heads, p for six words or more."""
    n = F.size(F.split(F.trim(text), "\\s+"))
    return (
        F.when(text.rlike("^\\s*(?:CHAPTER|PART|SCHEDULE|APPENDIX)\\b"), "h2")
        .when(n >= 6, "p")
        .when(~text.rlike("\\p{Ll}") & text.rlike("\\p{Lu}"), "h3")
        .when(text.rlike("^\\s*(?:[0-9]+|[A-Z]|[ivxIVX]+)[.)]"), "h4")
        .otherwise("p")
    )


def all_capital_starts(words: Column) -> Column:
    return F.forall(words, lambda w: ~w.rlike("^[a-z]"))


def destination_name(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), "[\\s.-]+", "-")


def only_marks(text: Column) -> Column:
    """Texts of punctuation and spaces only, which a translator passes through."""
    return text.rlike("^[\\s,()=-]*$")


#: Sources whose documents go to a collection of their own, and the collection of all others.
COLLECTIONS = {"rsa": "ArchivesOfIndia"}
COLLECTION = "gazetteofindia"


def collection(source: Column) -> Column:
    """The collection that a source's documents are published in."""
    return F.coalesce(F.try_element_at(_map(COLLECTIONS), source), F.lit(COLLECTION))


def plain_ampersands(text: Column) -> Column:
    """&amp; as it was meant in an address."""
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def value_text(value: Column) -> Column:
    """A metadata value (variant) as text: trimmed text, numbers and dates as they are written, '' for lists, objects and null."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    nested = kind.rlike("^(?:ARRAY|OBJECT|STRUCT)")
    return F.when(value.isNull() | nested | (kind == "VOID"), "").when(kind == "STRING", F.btrim(text)).otherwise(F.coalesce(text, F.lit("")))


def json_of(record: Column) -> Column:
    """A record (struct, map, array or variant) as JSON: dates as yyyy-mm-dd, times by ISO 8601, nulls of a struct kept."""
    return F.to_json(record, {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"})


def source_defaults(name: Column, category: Column, authority: Column, languages: Column, prefix: Column, start: Column) -> Column:
    """A source's record with what is left out filled in: title from the name, '' for the authority, no languages, the usual prefix."""
    return F.struct(
        name.alias("name"), F.coalesce(F.when(category != "", category), F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))).alias("title"),
        F.coalesce(authority, F.lit("")).alias("authority"), F.coalesce(languages, F.array().cast("array<string>")).alias("languages"),
        F.coalesce(prefix, F.concat(F.lit("in.gazette."), name, F.lit("."))).alias("prefix"), start.cast("date").alias("start_date"),
    )
