"""Scalar normalisation and policy as Column expressions: all visible to Catalyst, no Python per row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import policy as P
from .entities import let, unescape

UNICODE = "(?iuU)"


def matches(c: Column, pattern: str) -> Column:
    """A case-insensitive search with Unicode word classes; null counts as no match.

    Patterns are lower-case, so the text is lowered once instead of folding case at every character.
    """
    return F.coalesce(F.lower(c).rlike("(?U)" + pattern), F.lit(False))


#: All characters of the Unicode property White_Space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Trim all Unicode white space (``trim`` alone only knows the space)."""
    return F.btrim(c, F.lit(WHITE))


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def normalize_token(c: Column) -> Column:
    return squeeze(strip(F.lower(text(c))))


def normalize_title(c: Column) -> Column:
    return F.lower(squeeze(F.regexp_replace(strip(text(c)), r"(?U)\s*\(#\d+\)\s*$", "")))


def canonical_company(c: Column) -> Column:
    token = normalize_token(c)
    names = F.create_map(*[F.lit(x) for pair in P.COMPANY_ALIASES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, token), F.try_element_at(names, F.replace(token, F.lit("-"), F.lit(" "))), token)


# --- URLs -------------------------------------------------------------------------------------------------------------


def url_encode(c: Column) -> Column:
    """Form encoding that leaves ``~`` and encodes ``*``; most keys and values need none."""
    encoded = F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
    return F.when(c.rlike("^[A-Za-z0-9._~-]*$"), c).otherwise(encoded)


def _query_pairs(query: Column) -> Column:
    """``k=v&...`` as structs of decoded key and value; empty pieces are dropped, blank values stay."""
    parts = F.filter(F.split(text(query), "&"), lambda p: p != "")
    decoded = lambda c: F.when(c.rlike("[%+]"), F.coalesce(F.try_url_decode(c), c)).otherwise(c)
    return F.transform(parts, lambda p: F.struct(decoded(F.regexp_extract(p, "(?s)^([^=]*)", 1)).alias("k"), decoded(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("v")))


def _url_parts(url: Column) -> dict[str, Column]:
    """scheme, authority, path and query by plain patterns, so a malformed url passes through."""
    part = lambda p, g=1: F.regexp_extract(url, p, g)
    scheme = F.lower(part(r"^([A-Za-z][A-Za-z0-9+.\-]*):"))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    authority = F.regexp_extract(rest, r"^//([^/?#]*)", 1)
    tail = F.regexp_replace(rest, r"^//[^/?#]*", "")
    return {"scheme": scheme, "authority": authority, "path": F.regexp_extract(tail, r"^([^?#]*)", 1), "query": F.regexp_extract(tail, r"^[^?#]*\?([^#]*)", 1)}


def host_of(authority: Column) -> Column:
    return F.lower(F.regexp_extract(authority, r"^(?:.*@)?([^:]*)", 1))


def on_host(host: Column, names: tuple[str, ...]) -> Column:
    """Whether a host is one of ``names`` or below it. One pattern, since a lambda over the names would find the host again for each."""
    return host.rlike(r"(?:^|\.)(?:" + "|".join(map(re.escape, names)) + r")\z")


def with_canonical_url(df: DataFrame, url: str = "url", out: str = "canonical_url") -> DataFrame:
    """One key for the spellings of a link: lower scheme and host, aliases, no default port, no trailing slash, no tracking
    keys, sorted query, no fragment. A null or blank link is ''; a port that is no number stays as part of the host's text
    rather than failing the run. In steps, so that each part of the link is computed once."""
    c, scheme = F.col, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"
    df = df.withColumn("_cu", strip(text(c(url))))
    df = df.withColumns({"_cs": F.lower(F.regexp_extract("_cu", r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)), "_ca": F.regexp_extract("_cu", scheme + r"//([^/?#]*)", 1), "_cp": F.regexp_extract("_cu", scheme + r"(?://[^/?#]*)?([^?#]*)", 1), "_cq": F.regexp_extract("_cu", r"^[^?#]*\?([^#]*)", 1)})
    host = host_of(c("_ca"))
    df = df.withColumns({"_cs": F.when(c("_cs") == "", "https").otherwise(c("_cs")), "_ch": host, "_cn": F.regexp_extract("_ca", r":([0-9]+)$", 1)})
    for name, alias in P.HOST_ALIASES.items():
        df = df.withColumn("_ch", F.when(c("_ch") == name, alias).otherwise(c("_ch")))
    own = [F.regexp_replace("_ch", r"^www\.", "") == h for h in P.HOST_TRACKING_QUERY_KEYS]
    keys = list(P.HOST_TRACKING_QUERY_KEYS.values())

    def kept(p):
        key = F.lower(p["k"])
        drop = key.rlike("^(?:utm_|(?:" + "|".join(P.TRACKING_QUERY_KEYS) + r")\z)")
        for here, k in zip(own, keys):
            drop = drop | (here & key.isin(*k))
        return ~drop

    pairs = F.sort_array(F.filter(_query_pairs(c("_cq")), kept))
    query = F.array_join(F.transform(pairs, lambda p: F.concat(url_encode(p["k"]), F.lit("="), url_encode(p["v"]))), "&")
    df = df.withColumn("_cq", F.when(c("_cq") == "", "").otherwise(query))
    shown = (c("_cn") != "") & (((c("_cs") == "http") & (c("_cn") != "80")) | ((c("_cs") == "https") & (c("_cn") != "443")))
    path = F.when(c("_cp").isin("", "/"), "/").otherwise(F.regexp_replace("_cp", "/+$", ""))
    whole = F.concat("_cs", F.lit("://"), "_ch", F.when(shown, F.concat(F.lit(":"), "_cn")).otherwise(""), path, F.when(c("_cq") == "", "").otherwise(F.concat(F.lit("?"), "_cq")))
    return df.withColumn(out, F.when(c("_cu") == "", "").otherwise(whole)).drop("_cu", "_cs", "_ca", "_cp", "_cq", "_ch", "_cn")


def strip_tracking(url: Column) -> Column:
    """Drop ``utm_*`` pairs and the fragment; order and spelling of the rest stay."""
    base = F.regexp_extract(text(url), r"^([^?#]*)", 1)
    query = F.regexp_extract(text(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).startswith("utm_")), "&")
    return F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept))


_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
#: Schemes in which a link may be relative.
_RELATIVE = ("", "http", "https", "ftp", "file")


def resolve_url(base: Column, href: Column) -> Column:
    """A page's link made absolute: what a browser would follow. A link of another scheme stays as it is, an empty one is the page; dot
    segments are resolved, and an empty query or fragment is dropped. Null counts as empty.

    Most links are whole, or paths from the root without dots, and need no more than the page's site before them.
    """
    site = F.regexp_extract(base, r"^https?://[^/?#\t\r\n]+(?=[/?#]|\z)", 0)
    tail = r"[^?#\t\r\n]*(?:\?[^#\t\r\n]+)?(?:#[^\t\r\n]+)?\z"
    rooted = href.rlike("^/(?!/)" + tail) & ~F.contains(href, F.lit("/."))
    whole = href.rlike(r"^https?://[^/?#\t\r\n]" + tail)
    return F.when((site != "") & rooted, F.concat(site, href)).when((site != "") & whole, href).otherwise(_resolve_any(base, href))


def _resolve_any(base: Column, href: Column) -> Column:
    tidy = lambda u: F.regexp_replace(F.regexp_replace(text(u), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    parts = lambda u: F.struct(*[F.regexp_extract(u, _PARTS, i).alias(f"p{i}") for i in range(1, 6)])
    cut = lambda x: F.struct(x.alias("whole"), parts(x).alias("parts"))
    both = F.struct(text(base).alias("base"), text(href).alias("href"), let(tidy(base), cut).alias("b"), let(tidy(href), cut).alias("h"))
    return let(both, _resolve_parts)


def _resolve_parts(x: Column) -> Column:
    b, h, part = x["b"], x["h"], lambda u, i: u["parts"][f"p{i}"]
    scheme, own = F.lower(part(b, 1)), F.lower(part(h, 1))
    same = own.isin("") | (own == scheme)
    site = lambda s, host: F.concat(F.when(s == "", "").otherwise(F.concat(s, F.lit(":"))), F.when(host == "", F.when(s == "file", "//").otherwise("")).otherwise(F.concat(F.lit("//"), host)))
    tail = lambda query, fragment: F.concat(F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)), F.when(fragment == "", "").otherwise(F.concat(F.lit("#"), fragment)))
    path, query, fragment = part(h, 3), part(h, 4), part(h, 5)
    here = F.concat(part(b, 3), tail(F.when(query == "", part(b, 4)).otherwise(query), fragment))

    folder, steps = F.split(part(b, 3), "/"), F.split(path, "/")
    folder = F.when(F.element_at(folder, -1) == "", folder).otherwise(F.slice(folder, F.lit(1), F.size(folder) - 1))
    filled = lambda all_: F.filter(all_, lambda s, i: (s != "") | (i == 0) | (i == F.size(all_) - 1))
    up = lambda done: F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
    fold = lambda all_: F.aggregate(all_, F.array().cast("array<string>"), lambda done, s: F.when(s == "..", up(done)).when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    walk = lambda all_: F.concat(fold(all_), F.when(F.element_at(all_, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))
    walked = let(F.when(path.startswith("/"), steps).otherwise(let(F.concat(folder, steps), filled)), walk)
    resolved = F.coalesce(F.nullif(F.array_join(walked, "/"), F.lit("")), F.lit("/"))
    resolved = let(resolved, lambda r: F.when((part(b, 2) == "") | r.startswith("/"), r).otherwise(F.concat(F.lit("/"), r)))

    there = F.when(h["whole"].rlike(r"(?s)^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]+"), F.concat(site(scheme, part(h, 2)), path, tail(query, fragment)))
    there = there.when(path == "", F.concat(site(scheme, part(b, 2)), here)).otherwise(F.concat(site(scheme, part(b, 2)), resolved, tail(query, fragment)))
    return F.when(x["base"] == "", x["href"]).when(x["href"] == "", x["base"]).when(~same | ~scheme.isin(*_RELATIVE), x["href"]).otherwise(there)


def title_from_slug(url: Column) -> Column:
    """The last path segment with ``-`` and ``_`` as spaces."""
    path = F.regexp_replace(_url_parts(text(url))["path"], "/+$", "")
    return strip(F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), "[-_]", " "))


def source_id(company: Column, url: Column) -> Column:
    """``company:<name>@<host without www.>``."""
    host = F.regexp_replace(host_of(_url_parts(text(url))["authority"]), r"^www\.", "")
    return F.concat(F.lit("company:"), text(company), F.lit("@"), host)


def authority(url: Column) -> Column:
    return _url_parts(text(url))["authority"]


def _public_v4(host: Column) -> Column:
    """Whether a dotted address is one of the open internet; null where ``host`` is no such address."""
    octets = F.transform(F.split(host, r"\."), lambda x: x.cast("int"))
    address = host.rlike(r"^(?:(?:0|[1-9][0-9]{0,2})\.){3}(?:0|[1-9][0-9]{0,2})$") & ~F.exists(octets, lambda o: o > 255)
    n = F.aggregate(octets, F.lit(0).cast("long"), lambda acc, o: acc * 256 + o)
    private = F.lit(False)
    for block in P.PRIVATE_V4:
        net, _, bits = block.partition("/")
        low = sum(int(x) << 8 * (3 - i) for i, x in enumerate(net.split(".")))
        private |= n.between(low, low + (1 << 32 - int(bits)) - 1)
    for one in P.PUBLIC_V4:
        private &= n != sum(int(x) << 8 * (3 - i) for i, x in enumerate(one.split(".")))
    return F.when(address, ~private)


def _public_v6(host: Column) -> Column:
    """Whether a bracketed address is in the part of IPv6 given out for the open internet."""
    word = lambda i: F.coalesce(F.conv(F.concat(F.lit("0"), F.get(F.split(host, ":"), i)), 16, 10).cast("int"), F.lit(0))
    a, b = word(0), word(1)
    special = ((a == 0x2001) & ((b < 0x200) | (b == 0xDB8))) | (a == 0x2002) | ((a == 0x3FFF) & (b < 0x1000))
    return a.between(0x2000, 0x3FFF) & ~special


def same_origin(target: Column, base: Column) -> Column:
    """Whether a link may be followed from ``base``: https on both with the same host and the same port as written, no user in the link,
    and no host of this machine, of the local network or of an address that is not public."""
    t, b = _url_parts(text(target)), _url_parts(text(base))
    user = F.regexp_extract(t["authority"], r"(?s)^(.*)@", 1)
    bare = lambda x: F.lower(F.regexp_replace(x["authority"], r"(?s)^.*@", ""))
    v6 = F.regexp_extract(bare(t), r"^\[([0-9a-f:.]+)\]", 1)
    host = F.when(v6 != "", v6).otherwise(F.regexp_extract(bare(t), r"^([^:\[\]]*)(?::[0-9]*)?$", 1))
    port = F.regexp_extract(bare(t), r":([0-9]*)$", 1)
    same = bare(t) == bare(b)
    local = (host == "localhost") | host.endswith(".localhost") | host.endswith(".local")
    public = F.when(v6 != "", _public_v6(v6)).otherwise(F.coalesce(_public_v4(host), F.lit(True)))
    ok = (t["scheme"] == "https") & (b["scheme"] == "https") & user.isin("", ":") & (host != "") & (F.coalesce(port.try_cast("int"), F.lit(0)) <= 65535) & same & ~local & public
    return F.coalesce(ok, F.lit(False))


# --- identity ---------------------------------------------------------------------------------------------------------


def identity_strategy(canonical_url: Column, source_job_id: Column) -> Column:
    return F.when(text(source_job_id) != "", "source_job_id").when(canonical_url != "", "canonical_url").otherwise("fallback")


def identity_key(canonical: Column, canonical_url: Column, source: Column, source_job_id: Column) -> Column:
    """A posting's key, from its ``canonical_company`` and canonical url."""
    job = text(source_job_id)
    raw = F.when(job != "", F.concat_ws("|", F.lit("provider"), canonical, normalize_token(source), strip(job)))
    raw = raw.when(canonical_url != "", F.concat_ws("|", F.lit("url"), canonical, canonical_url))
    return F.sha2(raw.otherwise(F.concat_ws("|", F.lit("fallback"), canonical, F.lit(""))), 256)


def content_hash(company: Column, title: Column, location: Column) -> Column:
    return F.sha2(F.concat_ws("|", canonical_company(company), normalize_title(title), normalize_token(location)), 256)


def role_title(title: Column) -> Column:
    return normalize_title(title)


def role_family_title(title: Column) -> Column:
    """The title of a role family: no qualifier, no seniority but lead, developer as engineer. Titles that do
    not name the platform outside a qualifier keep their normal form."""
    whole = normalize_title(title)
    base = F.regexp_replace(whole, P.TITLE_QUALIFIER, " ")
    short = F.regexp_replace(F.regexp_replace(base, P.TITLE_SENIORITY, " "), P.TITLE_DEVELOPER, "engineer")
    short = strip(F.regexp_replace(short, r"(?U)[\s,/|–-]+", " "))
    return F.when(matches(base, P.PLATFORM_ANCHOR), short).otherwise(whole)


# --- topic and level ----------------------------------------------------------------------------------------------------


def is_platform_job(title: Column, description: Column | None = None) -> Column:
    by_body = F.lit(False) if description is None else matches(description, P.CORE_TERMS) & matches(title, P.BODY_ROLE)
    return ~matches(title, P.EXCLUDED_ROLE) & (matches(title, P.PLATFORM_ANCHOR) | by_body)


def adjacent_topic(title: Column) -> Column:
    mobile = matches(title, P.MOBILE_TITLE) & ~matches(title, P.OTHER_MOBILE_PLATFORM)
    return F.when(matches(title, P.EXCLUDED_ROLE), F.lit(None)).when(matches(title, P.KMP_TITLE), "kmp").when(mobile, "mobile")


def is_target_job(title: Column, description: Column | None = None) -> Column:
    return is_platform_job(title, description) | adjacent_topic(title).isNotNull()


def is_primary_role(title: Column) -> Column:
    return matches(title, P.NATIVE_TITLE) & is_platform_job(title) & ~matches(title, P.CROSS_PLATFORM_TITLE)


def topic(title: Column, description: Column) -> Column:
    """How a posting relates to the platform, null when off topic."""
    adjacent = adjacent_topic(title)
    return (
        F.when(is_primary_role(title), "native_ios")
        .when(F.coalesce(adjacent == "kmp", F.lit(False)), "kmp")
        .when(~is_platform_job(title, description), adjacent)
        .when(matches(title, P.CROSS_PLATFORM_TITLE), "cross_platform")
        .when(is_platform_job(title), "apple_platform")
        .otherwise("ios_in_description")
    )


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once a row: filters on it stay above it instead of repeating it below."""
    return df.withColumn(name, F.explode(F.array(value)))


def with_topic(df: DataFrame) -> DataFrame:
    """``topic`` and ``primary`` (``is_primary_role``) of postings in steps: the title is lowered once and searched once for each
    pattern, the description only where the title leaves it open."""
    c, none = F.col, F.lit(None).cast("string")
    patterns = {"_excluded": P.EXCLUDED_ROLE, "_anchor": P.PLATFORM_ANCHOR, "_kmp": P.KMP_TITLE, "_mobile": P.MOBILE_TITLE, "_other": P.OTHER_MOBILE_PLATFORM, "_native": P.NATIVE_TITLE, "_cross": P.CROSS_PLATFORM_TITLE, "_role": P.BODY_ROLE}
    low = F.coalesce(F.lower("title"), F.lit(""))
    df = df.withColumn("_low", low)
    df = df.withColumns({k: c("_low").rlike("(?U)" + p) for k, p in patterns.items()})
    named = ~c("_excluded") & c("_anchor")
    by_body = F.when(~c("_excluded") & ~c("_anchor") & c("_role"), matches(c("description"), P.CORE_TERMS)).otherwise(False)
    df = df.withColumn("_platform", named | by_body)
    primary = c("_native") & named & ~c("_cross")
    adjacent = F.when(c("_excluded"), none).when(c("_kmp"), "kmp").when(c("_mobile") & ~c("_other"), "mobile")
    topic_ = F.when(primary, "native_ios").when(c("_kmp") & ~c("_excluded"), "kmp").when(~c("_platform"), adjacent).when(c("_cross"), "cross_platform").when(named, "apple_platform").otherwise("ios_in_description")
    df = once(df, "_topic", F.struct(topic_.alias("topic"), primary.alias("primary")))
    return df.withColumns({"topic": c("_topic.topic"), "primary": c("_topic.primary")}).drop("_low", "_platform", "_topic", *patterns)


def is_inbox_candidate(track: Column, title: Column) -> Column:
    return (track == "ios") & is_primary_role(title)


def is_handover_candidate(track: Column, title: Column, description: Column) -> Column:
    return (track == "ai") | topic(title, description).isNotNull()


def is_target_level(title: Column) -> Column:
    return ~(matches(title, P.JUNIOR_TITLE) & ~matches(title, P.SENIORISH_TITLE))


def title_level(title: Column) -> Column:
    out = F.when(F.lit(False), "")
    for level, pattern in P.LEVELS:
        out = out.when(matches(title, pattern), level)
    return out.when(matches(title, P.JUNIOR_TITLE), "junior").otherwise("unknown")


def language(c: Column) -> Column:
    """A guess by script: ``unknown`` without letters, ``en`` under 30 percent Cyrillic, else uk or ru."""
    c = text(c)
    letters, cyrillic = F.regexp_count(c, F.lit(r"\p{L}")), F.regexp_count(c, F.lit(r"[\x{400}-\x{4ff}&&\p{L}]"))
    low = F.lower(c)
    uk, ru = F.regexp_count(low, F.lit("[іїєґ]")), F.regexp_count(low, F.lit("[ыэъё]"))
    return F.when(letters == 0, "unknown").when(cyrillic < letters * 0.3, "en").when(uk >= ru, "uk").otherwise("ru")


# --- location and work mode ---------------------------------------------------------------------------------------------


def is_work_mode_eligible(location: Column, remote: Column) -> Column:
    value, mode = strip(text(location)), F.lower(strip(text(remote)))
    office = mode.isin("onsite", "on-site", "office", "hybrid") | matches(value, P.OFFICE_LOCATION)
    return F.when(value == "", True).when(matches(value, P.KYIV), True).when(office, False).otherwise((mode == "remote") | matches(value, P.REMOTE_LOCATION))


def is_location_eligible(location: Column, remote: Column) -> Column:
    value = strip(text(location))
    scope = F.regexp_replace(F.regexp_replace(value, UNICODE + P.REMOTE_LOCATION, ""), UNICODE + P.SCOPE_WORDS, "")
    left = F.translate(scope, P.SCOPE_PUNCTUATION, "") != ""
    home = (value == "") | matches(value, P.KYIV) | matches(value, P.UKRAINE)
    return is_work_mode_eligible(location, remote) & (home | ~left)


def location_attention(location: Column, remote: Column) -> Column:
    return is_work_mode_eligible(location, remote) & ((strip(text(location)) == "") | ~is_location_eligible(location, remote))


def workable(location: Column, remote: Column) -> Column:
    """Null where the posting names neither a place nor remote work."""
    unknown = (strip(text(location)) == "") & (F.lower(strip(text(remote))) != "remote")
    return F.when(~unknown, is_work_mode_eligible(location, remote))


def mode_of(low: Column) -> Column:
    """The work mode that a lower-case text names."""
    on = lambda pattern: low.rlike("(?U)" + pattern)
    return (
        F.when(on(P.NEGATED_REMOTE), "onsite")
        .when(on(r"\bhybrid\b"), "hybrid")
        .when(on(r"\bon[- ]?site\b"), "onsite")
        .when(on(P.REMOTE_LOCATION), "remote")
        .when(on(r"\boffice\b"), "onsite")
        .otherwise("unknown")
    )


def infer_remote(title: Column, location: Column, description: Column) -> Column:
    return mode_of(F.lower(F.concat_ws(" ", text(title), text(location), text(description))))


# --- requirements -------------------------------------------------------------------------------------------------------


def html_text(c: Column) -> Column:
    """Text of an HTML fragment: script and style out, block ends as line breaks, tags as spaces, character references decoded."""
    c = F.regexp_replace(text(c), r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    c = F.regexp_replace(c, r"(?i)</(?:p|li|div|h[1-4])\s*>|<br\s*/?>", "\n")
    return unescape(F.regexp_replace(c, r"(?s)<[^>]+>", " "))


def required_lines(plain: Column) -> Column:
    """Requirement clauses of a ``plain`` text, one array element each: clauses of optional sections and optional clauses are out,
    those of a required section start with ``required: ``. Each line is classified and cut once; then the
    running section is folded over the lines."""
    lines = F.transform(F.split(plain, r"[\n;]|(?<=[.!?])\s+"), strip)
    kind = lambda x: F.when(matches(x, P.OPTIONAL_SECTION), "o").when(matches(x, P.NEUTRAL_SECTION), "n").when(matches(x, P.REQUIRED_SECTION), "r").otherwise("")
    clauses = lambda x: F.transform(F.filter(F.split(x, UNICODE + P.CLAUSE_SPLIT), lambda c: ~matches(c, P.OPTIONAL_CLAUSE)), strip)
    cut = F.transform(lines, lambda x: F.struct(kind(x).alias("k"), clauses(x).alias("c")))

    def fold(acc, x):
        optional = F.when(x["k"] == "", acc["o"]).otherwise(x["k"] == "o")
        required = F.when(x["k"].isin("", "o"), acc["r"]).otherwise(x["k"] == "r")
        named = F.when(required, F.transform(x["c"], lambda c: F.concat(F.lit("required: "), c))).otherwise(x["c"])
        return F.struct(optional.alias("o"), required.alias("r"), F.when(optional, acc["out"]).otherwise(F.concat(acc["out"], named)).alias("out"))

    zero = F.struct(F.lit(False).alias("o"), F.lit(False).alias("r"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(cut, zero, fold, lambda a: a["out"])


def authorization_blockers(description: Column, plain: Column | None = None) -> Column:
    """Ordered distinct requirements that cannot be met from abroad; ``plain`` is the description's text where it is known already.

    A text without any word of the requirements has none, so only the others are cut into sentences.
    """
    sentences = F.split(F.lower(F.array_join(required_lines(html_text(description) if plain is None else plain), "\n")), r"(?<=[.!?])\s+|[\n;]")
    on = lambda s, pattern: s.rlike("(?U)" + pattern)
    hit = F.filter(sentences, lambda s: on(s, P.AUTHORIZATION_REQUIRED) & ~on(s, P.AUTHORIZATION_SUPPORT) & ~on(s, P.UKRAINE))

    def named(s):
        out = F.when(F.lit(False), "")
        for pattern, name in P.BLOCKERS[:-1]:
            out = out.when(on(s, pattern), name)
        return out.otherwise(P.BLOCKERS[-1][1])

    maybe = text(description).rlike(r"(?iu)authori[sz]|eligib|right|permit|visa|citizen|resident|clearance")
    return F.when(maybe, F.array_distinct(F.transform(hit, named))).otherwise(F.array().cast("array<string>"))


# --- labels -------------------------------------------------------------------------------------------------------------


def labels(plain: Column | None = None) -> dict[str, Column]:
    """Label columns of a normal posting, whose topic is already known, and maybe the ``plain`` text of its description."""
    c = F.col
    return {
        "track": c("track"),
        "topic": F.coalesce(c("topic"), F.lit("off_topic")),
        "junior": ~is_target_level(c("title")),
        "level": title_level(c("title")),
        "work_mode": F.coalesce(F.nullif(F.lower(strip(F.coalesce(c("remote"), F.lit("unknown")))), F.lit("")), F.lit("unknown")),
        "workable": workable(c("location"), c("remote")),
        "location_needs_check": location_attention(c("location"), c("remote")),
        "work_authorization": authorization_blockers(c("description"), plain),
    }


def title_marks() -> Column:
    """The title with its marks, the flag first."""
    c = F.col
    on = [
        (c("russian_company"), P.MARK_FLAG),
        (F.size(authorization_blockers(c("description"))) > 0, P.MARK_PERMIT),
        (~is_work_mode_eligible(c("location"), c("remote")), P.MARK_OFFICE),
        (location_attention(c("location"), c("remote")), P.MARK_CHECK),
        (~is_target_level(c("title")), P.MARK_JUNIOR),
    ]
    return F.concat(*[F.when(F.coalesce(when, F.lit(False)), mark + " ").otherwise("") for when, mark in on], strip(text(c("title"))))


def number_form(n: Column, one: str, few: str, many: str) -> Column:
    """The noun form after a number: 1, 2-4 or other, with the teens as other."""
    n = F.abs(n) % 100
    return F.when((n % 10 == 1) & (n != 11), one).when((n % 10).between(2, 4) & ~n.between(12, 14), few).otherwise(many)


def short_list(names: Column, shown: int = 3) -> Column:
    """The first names, with how many more there are."""
    more = F.size(names) - shown
    head = F.array_join(F.slice(names, 1, shown), ", ")
    return F.when(more > 0, F.concat(head, F.lit(" (+"), more.cast("string"), F.lit(")"))).otherwise(head)


def redact_token(url: Column, token: str) -> Column:
    """``url`` with the token masked: in a bot's path where it stands there, else wherever it is."""
    if not token:
        return url
    parts = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+)(/bot[^?#]*)?(.*)$"
    site, path, rest = (F.regexp_extract(url, parts, i) for i in (1, 2, 3))
    at = F.locate(f"/bot{token}", path)
    masked = F.when(at == 0, path).otherwise(F.concat(F.substr(path, F.lit(1), at - 1), F.lit("/bot[redacted]"), F.substr(path, at + len(token) + 4)))
    return F.when(~F.contains(url, F.lit(token)), url).when(path != "", F.concat(site, masked, rest)).otherwise(F.replace(url, F.lit(token), F.lit("[redacted]")))


# --- fixed values: what pages say that stand between a client and the site, and the length beyond which a page is a real one
BOT_WALL_MARKERS = ("_Incapsula_Resource", "Attention Required! | Cloudflare", "cf-browser-verification", "cf_chl_opt", "Just a moment...", "Checking your browser before accessing", "Request unsuccessful. Incapsula incident ID")
BOT_WALL_LENGTH = 24_000


def looks_like_bot_wall(body: Column) -> Column:
    """Whether a short page is a wall for automated clients; null is none."""
    low = F.lower(body)
    return F.coalesce((F.length(body) <= BOT_WALL_LENGTH) & F.exists(F.array(*[F.lit(m.lower()) for m in BOT_WALL_MARKERS]), lambda m: F.contains(low, m)), F.lit(False))


def safe_error(c: Column, secrets: tuple[str, ...] = ()) -> Column:
    c = text(c)
    for s in secrets:
        if len(s) >= 4:
            c = F.replace(c, F.lit(s), F.lit("[redacted]"))
    return F.substring(F.regexp_replace(c, r"https?://\S+", "[url]"), 1, 500)
