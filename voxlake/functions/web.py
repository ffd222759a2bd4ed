"""HTML entities and video links."""

import html
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlake.fixed_values import SHORT_HOST, WATCH_HOST
from voxlake.functions.cleaning import strip

ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: Names that count without a semicolon, and so at the beginning of a longer one.
_OPEN = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
#: What numbers below 160 mean; the standard gives many of them another character, or none.
_LOW = [html.unescape(f"&#{number};") for number in range(0xA0)]


def _constant(value: dict | list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), kind)  # folded into one literal


def _character(number: Column) -> Column:
    """The character of a number, null for a number with too many digits."""
    nothing = number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE)
    plain = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return (F.when(number < len(_LOW), F.get(_constant(_LOW, "array<string>"), number.cast("int")))
            .when(number.between(0xD800, 0xDFFF) | (number > 0x10FFFF) | number.isNull(), "\ufffd")
            .when(nothing, "").otherwise(plain))


def _numbered(token: Column) -> Column:
    digits = F.regexp_extract(token, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    short = F.when(digits == "", "0").when(F.length(digits) <= 8, digits)
    is_hex = F.lower(F.substring(token, 3, 1)) == "x"
    return _character(F.when(is_hex, F.conv(short, 16, 10)).otherwise(short).cast("long"))


def _named(token: Column) -> Column:
    names = _constant(html5, "map<string,string>")
    name = F.substring(token, 2, 40)
    begins = F.regexp_extract(name, f"^({'|'.join(_OPEN)})", 1)
    rest = F.substring(name, F.length(begins) + 1, F.lit(40))
    return (F.when(name == "amp;", "&").when(name == "lt;", "<").when(name == "gt;", ">")
            .when(name == "quot;", '"').when(name == "nbsp;", "\xa0")
            .otherwise(F.coalesce(F.element_at(names, name), F.when(
                begins != "", F.concat(F.element_at(names, begins), rest)), token)))


def unescape_entities(text: Column) -> Column:
    """All HTML entities decoded, as the standard has them: numbers, names, names left open."""
    def decoded(raw: Column) -> Column:
        found = F.transform(F.regexp_extract_all(raw, F.lit(ENTITY), F.lit(0)), lambda token: F.when(
            F.startswith(token, F.lit("&#")), _numbered(token)).otherwise(_named(token)))
        return F.array_join(F.zip_with(
            F.split(raw, ENTITY), found,
            lambda part, character: F.concat(part, F.coalesce(character, F.lit("")))), "")

    return F.when(F.contains(text, F.lit("&")), decoded(text)).otherwise(text)


def unescape_basic_entities(text: Column) -> Column:
    """The five XML entities decoded, without leaving the JVM."""
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                              ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def video_key(raw: Column) -> Column:
    """Video id from an id or a link: short-link path, else ?v=, else the part before & and ?."""
    value = strip(raw)
    host = F.regexp_extract(value, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1)
    path = F.regexp_extract(value, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//[^/?#]*/*([^/?#]*)", 1)
    query_id = F.regexp_extract(value, r"^[^?#]*\?(?:[^#]*?&)?v=([^&#]+)", 1)
    plain_id = F.coalesce(F.try_url_decode(query_id), query_id)
    cut = strip(F.substring_index(F.substring_index(value, "&", 1), "?", 1))
    has_host = F.contains(value, F.lit(WATCH_HOST)) | F.contains(value, F.lit(SHORT_HOST))
    return (F.when(has_host & F.contains(host, F.lit(SHORT_HOST)), path)
            .when(has_host & (plain_id != ""), plain_id)
            .otherwise(cut))
