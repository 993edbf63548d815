"""Text functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def squeeze(c: Column) -> Column:
    """White space collapsed to single blanks, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def hebrew_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^֐-׿]", "")


def hebrew_words(c: Column, glue: str = "_") -> Column:
    return F.array_join(F.regexp_extract_all(c, F.lit("([א-ת]+)"), F.lit(1)), glue)


def split_trim(c: Column, separator: str = ";") -> Column:
    """Trimmed parts without empty ones; null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), separator), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def split_once(c: Column, separator: str = ":") -> tuple[Column, Column]:
    """What stands before and after the first separator."""
    at = F.instr(c, separator)
    head = F.when(at > 0, F.substring_index(c, separator, 1)).otherwise(c)
    return head, F.when(at > 0, c.substr(at + len(separator), F.length(c)))


def join_filled(glue: str, *columns: Column) -> Column:
    """Columns that are neither null nor empty, joined."""
    return F.array_join(F.filter(F.array(*columns), lambda x: x.isNotNull() & (x != "")), glue)


def cut_at(c: Column, marker: str, tail: str = " ()") -> Column:
    """Text before a marker with a tail in its place; unchanged without the marker."""
    return F.when(F.instr(c, marker) > 0, F.concat(F.substring_index(c, marker, 1), F.lit(tail))).otherwise(c)


def backslash_to_dash(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit(" - "))


def blank_placeholders(c: Column) -> Column:
    """Null for text of underscores or hyphens only, or none at all."""
    return F.when(~c.rlike("^(_*|-*)$"), c)


def statistical_value(c: Column) -> Column:
    """'' for the marks that tables use for missing or odd values: dots, a hyphen, (x), .000, two decimal points."""
    odd = c.rlike(r"^\s*(\.\.|-|\(x\)|\.0+)\s*$") | c.rlike(r"\..*\.")
    return F.when(c.isNull(), c).when(odd, "").otherwise(c)


def nice_hierarchy(*levels: Column) -> Column:
    return join_filled(" / ", *levels)


def html_to_text(c: Column) -> Column:
    """Block tags as line breaks, other tags away, common entities decoded, blank lines collapsed."""
    text = F.regexp_replace(c, r"(?i)</?(p|div|br|li|ul|ol|tr|table|h[1-6])\b[^>]*>", "\n")
    text = F.regexp_replace(text, "<[^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.regexp_replace(F.regexp_replace(text, r"\s*\n\s*", "\n"), r"^\s+|\s+$", "")


def visible_text(c: Column) -> Column:
    """html_to_text without scripts, styles and comments."""
    return html_to_text(F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", ""))


def sanitize_html(c: Column) -> Column:
    """Tags keep only href and target attributes; scripts and styles go."""
    text = F.regexp_replace(c, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", "")
    return F.regexp_replace(text, r"""(?i)\s(?!href=|target=)[a-z][\w-]*\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "")


def escape_ampersand(c: Column) -> Column:
    return F.replace(c, F.lit("&"), F.lit("&amp;"))


def query_parameter(c: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(c, rf"[?&]{name}=([^&#]*)", 1), F.lit(""))


def path_piece(c: Column, place: int) -> Column:
    """A piece of a URL's path; negative places count from the end."""
    pieces = F.filter(F.split(F.regexp_extract(c, "^(?:[a-z]+://[^/]*)?([^?#]*)", 1), "/"), lambda x: x != "")
    return F.get(pieces, F.lit(place) if place >= 0 else F.size(pieces) + place)


def absolute_url(c: Column, base: str) -> Column:
    return F.when(c.startswith("http"), c).otherwise(F.concat(F.lit(base), c))


def phone(c: Column) -> Column:
    """0X-XXX-XXXX forms of Israeli numbers of 9 or 10 digits, +972 as 0; else the text as it is."""
    digits = F.regexp_replace(F.regexp_replace(c, "[^0-9]", ""), "^972", "0")
    return (
        F.when(digits.rlike("^0[0-9]{8}$"), F.regexp_replace(digits, "^(..)(...)(....)$", "$1-$2-$3"))
        .when(digits.rlike("^0[0-9]{9}$"), F.regexp_replace(digits, "^(...)(...)(....)$", "$1-$2-$3"))
        .otherwise(c)
    )


def address(street: Column, number: Column, city: Column, pob: Column) -> Column:
    """Street, number and city; a post box and city; or the city."""
    has = lambda c: c.isNotNull() & (c != "")
    line = F.when(has(street), F.concat_ws(" ", street, F.when(has(number), number))).when(has(pob), F.concat(F.lit("ת.ד. "), pob))
    return F.concat_ws(", ", line, F.when(has(city), city))


def format_money(c: Column) -> Column:
    """Two decimals below a thousand, none from there on, with the shekel sign."""
    return F.concat(F.when(c < 1000, F.format_number(c, 2)).otherwise(F.format_number(c, 0)), F.lit(" ₪"))


def format_percentage(c: Column) -> Column:
    return F.when(c.isNull(), "").when(c < 0.1, F.format_string("%.2f%%", c * 100)).otherwise(F.format_string("%.1f%%", c * 100))


def chunks(c: Column, size: int = 2000, overlap: int = 400, most: int = 500) -> Column:
    """Overlapping pieces of a text at strides of size - overlap, short last ones included."""
    stride = size - overlap
    text = F.coalesce(c, F.lit(""))
    starts = F.when(F.length(text) > 0, F.slice(F.sequence(F.lit(1), F.length(text), F.lit(stride)), 1, most)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda a: text.substr(a, F.lit(size)))


def semantic_tags(tags: Column, groups: list[list[str]]) -> Column:
    """Each tag with its synonyms: of the first group that holds a word of it, all forms; sorted, distinct."""

    def widened(tag: Column) -> Column:
        out = F.array(tag)
        for group in reversed(groups):
            hit = F.coalesce(*[F.when(F.instr(tag, w) > 0, F.array(*[F.replace(tag, F.lit(w), F.lit(x)) for x in group])) for w in group])
            out = F.coalesce(hit, out)
        return out

    return F.array_sort(F.array_distinct(F.flatten(F.transform(tags, widened))))


def gendered(gender: Column, male: str, female: str, other: str) -> Column:
    return F.when(gender == "m", male).when(gender == "f", female).otherwise(other)


def year_of_title(c: Column) -> Column:
    return F.regexp_extract(c, r"((?:19|20)[0-9]{2})", 1).try_cast("int")


def quarter_of_title(c: Column) -> Column:
    """A quarter by number or by Hebrew word."""
    named = F.lit(None).cast("int")
    for word, q in (("ראשון", 1), ("שני", 2), ("שלישי", 3), ("רביעי", 4)):
        named = F.when(c.contains("רבעון " + word), q).otherwise(named)
    return F.coalesce(F.regexp_extract(c, r"(?:רבעון|[Qq])\s*([1-4])", 1).try_cast("int"), named)


def emails_in(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"), F.lit(1))


def strip_formulas(c: Column) -> Column:
    """Spreadsheet text formulas, ="text", as plain quoted text."""
    return F.regexp_replace(c, '(^|,)="', '$1"')


def first_email(c: Column) -> Column:
    """The first address; '' without one."""
    return F.regexp_extract(c, "[a-zA-Z0-9_.]+@[a-zA-Z0-9_.]+", 0)


def anchor_text(c: Column) -> Column:
    """What the first link of some HTML shows; '' without one."""
    return F.regexp_extract(c, "<a[^>]+>(.*?)</a", 1)


def lone_budget_code(c: Column, skip: str) -> Column:
    """The ten digits of the only code in a list with commas, leaving out items that hold skip; shorter ones are led by 20 or 00."""
    items = F.filter(F.split(c, ","), lambda x: ~x.contains(skip))
    digits = F.regexp_replace(F.get(items, F.lit(0)), "[^0-9]", "")
    digits = F.when(F.length(digits) == 6, F.concat(F.lit("20"), digits)).otherwise(digits)
    digits = F.when(F.length(digits) == 8, F.concat(F.lit("00"), digits)).otherwise(digits)
    return F.when((F.size(items) == 1) & (F.length(digits) == 10), digits)


def without_prefixes(c: Column, prefixes: Sequence[str]) -> Column:
    """Each prefix cut off once, in the order given, where the text then begins with it."""
    for p in prefixes:
        c = F.when(c.startswith(p), c.substr(F.lit(len(p) + 1), F.length(c))).otherwise(c)
    return c


def corrected(c: Column, fixes: Mapping[str, str]) -> Column:
    """The fix of a text that has one; others stay."""
    table = F.create_map(*[F.lit(x) for pair in fixes.items() for x in pair])
    return F.coalesce(F.try_element_at(table, c), c)
