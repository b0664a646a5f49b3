"""URL, HTML, robots, charset and address functions."""

from __future__ import annotations

import codecs
import ipaddress
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import let, redact, spaced, trimmed

#: A frozen part of the public suffix list, longest first within a name.
SUFFIX_VERSION = "frozen-1"
SUFFIXES = ["ac.uk", "co.uk", "org.uk", "gov.uk", "ac.at", "com.fr", "asso.fr", "gouv.fr", "edu.pl", "com.pl", "edu.tr", "com.tr", "ac.il",
            "at", "be", "bg", "ch", "com", "cz", "de", "dk", "edu", "ee", "es", "eu", "fi", "fr", "gr", "hr", "hu", "ie", "info", "is", "it",
            "li", "lt", "lu", "lv", "mk", "mt", "net", "nl", "no", "org", "pl", "pt", "ro", "rs", "se", "si", "sk", "tr", "uk"]
#: Elements whose content is never text, and elements that break lines.
DROPPED = ["script", "style", "noscript", "svg", "template", "iframe"]
BLOCKS = "p|div|br|h[1-6]|li|ul|ol|table|tr|td|th|section|article|header|footer|nav|aside|main|blockquote|pre|hr"
#: Named entities.
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "mdash": "—", "ndash": "–", "hellip": "…",
            "rsquo": "’", "lsquo": "‘", "rdquo": "”", "ldquo": "“"}
#: File endings that are no pages.
BINARY = r"(?i)\.(pdf|docx?|xlsx?|pptx?|zip|rar|7z|jpe?g|png|gif|svg|mp4|mp3|csv)$"
HTML_TYPES = ["text/html", "application/xhtml+xml"]
#: Subdomain labels of services that are not websites of an organisation.
SERVICES = ["moodle", "ent", "intranet", "mondossierweb", "webmail", "mail", "smtp", "imap", "vpn", "sso", "cas", "ldap", "wifi", "glpi", "grr", "workflow",
            "dsi", "git", "gitlab", "nextcloud", "owncloud", "bbb", "apps", "api", "cdn", "static", "assets"]


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def suffix(host_name: Column) -> Column:
    """The longest frozen public suffix of a host, null if none."""
    known = F.array(*[F.lit(s) for s in sorted(SUFFIXES, key=len, reverse=True)])
    return F.get(F.filter(known, lambda s: F.endswith(host_name, F.concat(F.lit("."), s))), F.lit(0))


def registrable_domain(host_name: Column) -> Column:
    s = suffix(host_name)
    rest = F.substring(host_name, F.lit(1), F.char_length(host_name) - F.char_length(s) - 1)
    return F.when(s.isNotNull(), F.concat(F.element_at(F.split(rest, r"\."), -1), F.lit("."), s))


def website(raw: Column) -> Column:
    """Struct status, reason, url, hostname, domain of a published website value; the first rule that holds decides."""
    v = trimmed(raw)
    full = F.when(v.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), v).otherwise(F.concat(F.lit("https://"), v))
    parsed = host(full)
    scheme = F.lower(F.regexp_extract(full, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    user = full.rlike("^[A-Za-z][A-Za-z0-9+.-]*:(//)?[^/?#]*@")
    broken = v.rlike("(?i)^(https?|ftps?)") & ~v.rlike("(?i)^(https?|ftps?)://") & v.rlike("(?i)^(https?|ftps?)[:/;,.]*/")
    reason = (F.when(F.coalesce(v, F.lit("")) == "", "blank").when(v.rlike(r"\s"), "interior_whitespace").when(broken, "broken_scheme")
              .when(user, "userinfo_present").when(~scheme.isin("http", "https"), "non_http_scheme")
              .when(parsed.isNull(), "unparsable").when(F.instr(parsed, ".") == 0, "host_without_dot")
              .when(suffix(parsed).isNull(), "no_icann_public_suffix"))
    status = (F.when(reason.isNull(), "STRUCTURALLY_VALID").when(reason == "blank", "ABSENT")
              .when(reason.isin("userinfo_present", "non_http_scheme", "no_icann_public_suffix"), "NOT_A_WEBSITE").otherwise("MALFORMED"))
    ok = reason.isNull()
    return F.struct(status.alias("status"), reason.alias("reason"), F.when(ok, full).alias("url"), F.when(ok, parsed).alias("hostname"),
                    F.when(ok, registrable_domain(parsed)).alias("domain"))


def path_segments(url: Column) -> Column:
    """Decoded, non-empty path segments."""
    parts = F.split(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/")
    return F.transform(F.filter(parts, lambda s: s != ""), lambda s: F.coalesce(F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B"))), s))


def url_parent(url: Column) -> Column:
    s = path_segments(url)
    return F.when(F.size(s) > 0, F.concat(F.lit("/"), F.array_join(F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))), "/")))


def is_binary(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")).rlike(BINARY)


def adds_to_cart(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit("add-to-cart")).isNotNull()


def is_service_host(host_name: Column) -> Column:
    domain = registrable_domain(host_name)
    sub = F.substring(host_name, F.lit(1), F.char_length(host_name) - F.char_length(domain) - 1)
    labels = F.split(sub, r"\.")
    return (sub != "") & (F.arrays_overlap(labels, F.array(*[F.lit(s) for s in SERVICES])) | F.exists(labels, lambda x: x.rlike("^espace-.+")))


def in_scope(url: Column, root: Column) -> Column:
    same = registrable_domain(host(url)) == registrable_domain(host(root))
    return same & ~((F.lower(root).startswith("https:")) & F.lower(url).startswith("http:"))


def sitemap_url(root: Column) -> Column:
    return F.concat(F.lower(F.try_parse_url(root, F.lit("PROTOCOL"))), F.lit("://"), host(root), F.lit("/sitemap.xml"))


def redirect_facts(source: Column, target: Column) -> Column:
    a, b = host(source), host(target)
    return F.struct(b.isNull().alias("malformed"), (F.lower(source).startswith("https:") & F.lower(target).startswith("http:")).alias("downgraded"),
                    (a != b).alias("host_changed"), (registrable_domain(a) != registrable_domain(b)).alias("domain_changed"))


def without_content_tags(html: Column) -> Column:
    out = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for tag in DROPPED:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    return out


def named_entities(x: Column) -> Column:
    """Named entities; the ampersand last, so that nothing is decoded twice."""
    for name, to in [*((k, v) for k, v in ENTITIES.items() if k != "amp"), ("amp", "&")]:
        x = F.replace(x, F.lit(f"&{name};"), F.lit(to))
    return x


def entities(x: Column) -> Column:
    """Named and numeric entities, each decoded once; a number that is no character stays as it is."""
    pattern = F.lit(r"&#(?:[xX][0-9a-fA-F]+|[0-9]+);")

    def one(e: Column) -> Column:
        hexed = F.lower(F.substring(e, 3, 1)) == "x"
        digits = F.regexp_extract(e, r"^&#[xX]?0*([0-9a-fA-F]*);", 1)
        # more digits than any character has would overflow
        n = F.when(F.char_length(digits) <= 7, F.when(hexed, F.conv(digits, 16, 10)).otherwise(digits).try_cast("long"))
        n = F.when(digits == "", F.lit(0)).otherwise(n)
        ok = (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
        return F.when(ok, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")).otherwise(e)

    def decoded(x: Column) -> Column:
        found = F.transform(F.regexp_extract_all(x, pattern, F.lit(0)), one)
        between = F.transform(F.split(x, pattern, -1), named_entities)
        both = F.transform(F.arrays_zip(between.alias("gap"), found.alias("hit")), lambda p: F.concat(p["gap"], F.coalesce(p["hit"], F.lit(""))))
        return F.when(F.instr(x, "&#") > 0, F.array_join(both, "")).when(F.instr(x, "&") > 0, named_entities(x)).otherwise(x)

    return let(x, decoded)


def html_text(html: Column) -> Column:
    lines = F.split(entities(F.regexp_replace(F.regexp_replace(html, rf"(?i)</?({BLOCKS})\b[^>]*>", "\n"), "<[^>]+>", " ")), "\n")
    return F.array_join(F.filter(F.transform(lines, spaced), lambda x: x != ""), "\n")


def title(html: Column) -> Column:
    return spaced(entities(F.regexp_replace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), "<[^>]+>", " ")))


def declared_language(html: Column) -> Column:
    tag = trimmed(F.regexp_extract(html, r"""(?is)<html\b[^>]*\blang\s*=\s*["']([^"']+)["']""", 1))
    return F.when(tag.rlike("^[A-Za-z0-9-]{1,35}$"), tag)


def headings(html: Column) -> Column:
    stripped = without_content_tags(html)
    pattern = r"(?is)<h([1-3])\b[^>]*>(.*?)</h\1\s*>"
    level, body = (F.regexp_extract_all(stripped, F.lit(pattern), F.lit(k)) for k in (1, 2))
    return F.filter(F.transform(F.arrays_zip(level.alias("level"), body.alias("text")),
                                lambda h: F.struct(h["level"].cast("int").alias("level"), spaced(entities(F.regexp_replace(h["text"], "<[^>]+>", " "))).alias("text"))),
                    lambda h: h["text"] != "")


#: The main element, what carries its role (up to the first end of its own tag), an article: group 2 is the content.
CONTAINERS = [r"(?is)<(main)\b[^>]*>(.*?)</main\s*>",
              r"""(?is)<([a-z][a-z0-9]*)\b[^>]*\brole\s*=\s*["']main["'][^>]*>(.*?)(?:</\1\s*>|\z)""",
              r"(?is)<(article)\b[^>]*>(.*?)</article\s*>"]


def _found(s: Column) -> Column:
    """Does a page without content tags have a container?"""
    found = F.lit(False)
    for t in CONTAINERS:
        found = found | s.rlike(t)
    return found


def _main(s: Column) -> Column:
    """main_html of a page without content tags."""
    return F.coalesce(*[F.when(s.rlike(t), F.regexp_extract(s, t, 2)) for t in [*CONTAINERS, r"(?is)<(body)\b[^>]*>(.*?)</body\s*>"]], s)


def main_html(html: Column) -> Column:
    """The first container there is, or the body, or all."""
    return let(without_content_tags(html), _main)


def main_method(html: Column) -> Column:
    return let(without_content_tags(html), lambda s: F.when(_found(s), "MAIN_ELEMENT").otherwise("FULL_BODY"))


def page_text(html: Column) -> Column:
    return redact(html_text(main_html(html)))


def page_text_and_method(html: Column) -> Column:
    """Struct text, method: page_text and main_method, with the content tags taken out once."""
    return let(without_content_tags(html), lambda s: F.struct(redact(html_text(_main(s))).alias("text"), F.when(_found(s), "MAIN_ELEMENT").otherwise("FULL_BODY").alias("method")))


def anchors(html: Column, most: int = 200) -> Column:
    """(href, text) of the page's links, dropped schemes and artefacts aside, the first `most`."""
    s = without_content_tags(html)
    pattern = r"""(?is)<a\b[^>]*?\bhref=["']([^"']*)["'][^>]*>(.*?)</a\s*>"""
    href, text = (F.regexp_extract_all(s, F.lit(pattern), F.lit(k)) for k in (1, 2))
    both = F.transform(F.arrays_zip(href.alias("href"), text.alias("text")),
                       lambda a: F.struct(trimmed(entities(a["href"])).alias("href"), redact(html_text(a["text"])).alias("text")))
    ok = lambda a: (a["href"] != "") & ~a["href"].rlike(r"(?i)^(mailto|tel|javascript|data|file|ftp):|^#|[<>]")
    return F.slice(F.filter(both, ok), 1, most)


def is_html(media_type: Column) -> Column:
    return F.lower(trimmed(F.split_part(media_type, F.lit(";"), F.lit(1)))).isin(HTML_TYPES)


# --- robots -------------------------------------------------------------------------------------


def rule_regex(pattern: Column) -> Column:
    """A robots path pattern as a regular expression."""
    anchored = pattern.endswith("$")
    bare = F.when(anchored, F.substring(pattern, F.lit(1), F.char_length(pattern) - 1)).otherwise(pattern)
    quoted = F.regexp_replace(bare, r"([\\.\[\]{}()+?^$|])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(quoted, F.lit("*"), F.lit(".*")), F.when(anchored, "$").otherwise(""))


def specificity(pattern: Column) -> Column:
    return F.char_length(F.regexp_replace(pattern, r"[*]|\$$", "")) + F.when(pattern.endswith("$"), 1).otherwise(0)


def crawl_delay(published: Column) -> Column:
    return F.least(F.greatest(F.coalesce(published, F.lit(1.2)), F.lit(1.2)), F.lit(5.0))


def robots_status(status: Column, error: Column) -> Column:
    return (F.when(error.isNotNull() | status.isNull(), "UNREADABLE").when(status.between(200, 299), "READABLE")
            .when(status.between(400, 499), "NO_ROBOTS_FILE").otherwise("UNREADABLE"))


def parse_robots(body: str) -> list[dict]:
    """Groups of a robots file: agents, rules (allow, pattern), delay."""
    groups: list[dict] = []
    open_agents = False
    for line in body.splitlines():
        key, colon, value = line.partition("#")[0].partition(":")
        key, value = key.strip().lower(), value.strip()
        if not colon:
            continue
        if key == "user-agent":
            if not open_agents:
                groups.append({"agents": [], "rules": [], "delay": None})
            groups[-1]["agents"].append(value.lower())
            open_agents = True
        elif groups and key in ("allow", "disallow", "crawl-delay"):
            open_agents = False
            if key == "crawl-delay":
                try:
                    groups[-1]["delay"] = max(float(value), groups[-1]["delay"] or 0.0)
                except ValueError:
                    pass
            elif value:
                groups[-1]["rules"].append({"allow": key == "allow", "pattern": value})
    return groups


_RULES = T.ArrayType(T.StructType().add("allow", T.BooleanType()).add("pattern", T.StringType()))
ROBOTS = T.ArrayType(T.StructType().add("agents", T.ArrayType(T.StringType())).add("rules", _RULES).add("delay", T.DoubleType()))


@F.udf(ROBOTS, useArrow=True)
def robots_groups(body):
    return parse_robots(body or "")


def robots_allows(groups: Column, agent: str, path: Column) -> Column:
    """Exact agent groups replace the star's; the most specific rule decides, allow wins ties."""
    own = F.filter(groups, lambda g: F.array_contains(g["agents"], agent.lower()))
    star = F.filter(groups, lambda g: F.array_contains(g["agents"], "*"))
    rules = F.flatten(F.transform(F.when(F.size(own) > 0, own).otherwise(star), lambda g: g["rules"]))
    hits = F.filter(rules, lambda r: F.regexp_like(path, rule_regex(r["pattern"])))
    best = F.array_max(F.transform(hits, lambda r: F.struct(specificity(r["pattern"]).alias("s"), r["allow"].alias("allow"))))
    return F.coalesce(best["allow"], F.lit(True))


# --- bytes and addresses ------------------------------------------------------------------------


def resolve_charset(body: bytes, content_type: str | None) -> tuple[str, str]:
    """(charset, source): byte order mark, header, meta, UTF-8 probe, then windows-1252."""
    for mark, name in ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be")):
        if body.startswith(mark):
            return name, "BOM"
    found = [(re.search(r"""charset\s*=\s*["']?([\w-]+)""", content_type or "", re.I), "HTTP"),
             (re.search(r"""<meta[^>]+charset\s*=\s*["']?\s*([\w-]+)""", body[:1024].decode("latin-1"), re.I), "META")]
    for m, source in found:
        if m:
            try:
                return codecs.lookup(m[1]).name, source
            except LookupError:
                pass
    try:
        body.decode("utf-8")
        return "utf-8", "PROBE"
    except UnicodeDecodeError:
        return "windows-1252", "FALLBACK"


@F.udf(T.StructType().add("charset", T.StringType()).add("source", T.StringType()).add("text", T.StringType()), useArrow=True)
def decoded_body(body, content_type):
    if body is None:
        return None
    charset, source = resolve_charset(bytes(body), content_type)
    return {"charset": charset, "source": source, "text": bytes(body).decode(charset, "replace")}


def v4_number(address: Column) -> Column:
    """An IPv4 address as a number, null if it is none."""
    p = F.split(address, r"\.")
    ok = address.rlike(r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$")
    return F.when(ok, sum((p[i].cast("long") * 256 ** (3 - i) for i in range(1, 4)), p[0].cast("long") * 256**3))


#: Address blocks that are not public.
V4_BLOCKS = ["0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24",
             "192.88.99.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4"]


def is_public_v4(address: Column) -> Column:
    n = v4_number(address)
    inside = F.lit(False)
    for block in map(ipaddress.ip_network, V4_BLOCKS):
        inside = inside | n.between(int(block[0]), int(block[-1]))
    return ~inside


@F.udf(T.BooleanType(), useArrow=True)
def is_public_address(text):
    """IPv4, IPv6 and IPv4 mapped into IPv6."""
    try:
        a = ipaddress.ip_address((text or "").strip("[]"))
    except ValueError:
        return None
    a = getattr(a, "ipv4_mapped", None) or a
    if a.version == 4:
        return not any(a in ipaddress.ip_network(b) for b in V4_BLOCKS)
    return a.is_global and not a.is_multicast


def parse_sitemap(body: str) -> tuple[str, list[str]]:
    """(kind, locations) of a sitemap; anything malformed is unsupported and empty."""
    import xml.etree.ElementTree as ET

    try:
        root = ET.fromstring(body)
    except ET.ParseError:
        return "unsupported", []
    kind = root.tag.rpartition("}")[2]
    if kind not in ("urlset", "sitemapindex"):
        return "unsupported", []
    return kind, [e.text.strip() for e in root.iter() if e.tag.rpartition("}")[2] == "loc" and (e.text or "").strip()]


@F.udf(T.StructType().add("kind", T.StringType()).add("locs", T.ArrayType(T.StringType())), useArrow=True)
def sitemap(body):
    kind, locs = parse_sitemap(body or "")
    return {"kind": kind, "locs": locs}


def official_links(html: Column, wanted: str = "accredited") -> Column:
    """Distinct links to workbooks in a page, those that name `wanted` first."""
    found = F.array_distinct(F.array_union(F.regexp_extract_all(html, F.lit(r"""(?i)href=["']([^"']+\.xlsx[^"']*)["']"""), F.lit(1)),
                                           F.regexp_extract_all(html, F.lit(r"""(?i)(https?://[^\s"'<>]+\.xlsx)"""), F.lit(1))))
    return F.concat(F.filter(found, lambda u: F.contains(F.lower(u), F.lit(wanted))), F.filter(found, lambda u: ~F.contains(F.lower(u), F.lit(wanted))))
