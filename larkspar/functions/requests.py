"""Request addresses: validated up to the first refusal, resolved against a page, percent-encoding made canonical.

Rows are worked on in stages of plain columns, so that no stage's expression is repeated in the next.
Hosts outside ASCII keep their letters (no punycode), and an empty fragment is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import WHITE, trimmed
from .web import suffix

#: Schemes whose addresses always have a host, and the port each of ours means.
HOSTED = ["http", "https", "ftp", "ws", "wss"]
PORTS = {"http": 80, "https": 443}
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_NO_HOST = r"[\x00-\x20#/:<>?@\[\\\]^|%\x7f]"
_PATH_ESCAPED = r"[\x00-\x20\"#<>?`{}^\x7f]|[^\x00-\x7f]"
_QUERY_ESCAPED = r"[\x00-\x20\"#<>'\x7f]|[^\x00-\x7f]"


def _percent(c: Column) -> Column:
    return F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")


def _escaped(x: Column, pattern: str) -> Column:
    one = lambda c: F.when(c.rlike(pattern), _percent(c)).otherwise(c)
    return F.when(x.rlike(pattern), F.array_join(F.transform(F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0)), one), "")).otherwise(x)


def canonical_component(x: Column) -> Column:
    """One spelling of a robots path: unreserved bytes plain, others as upper-case escapes, written delimiters kept."""
    def one(c: Column) -> Column:
        plain = F.chr(F.conv(F.substring(c, 2, 2), 16, 10).cast("int"))
        return (F.when(c.rlike("^%..$"), F.when(plain.rlike("^[A-Za-z0-9._~-]$"), plain).otherwise(F.upper(c)))
                .when(c.rlike(r"^[A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=-]$"), c).otherwise(_percent(c)))

    return F.array_join(F.transform(F.regexp_extract_all(x, F.lit("(?s)%[0-9a-fA-F]{2}|."), F.lit(0)), one), "")


def _from(x: Column, at: Column) -> Column:
    return F.substring(x, at, F.char_length(x))


def _clean_path(path: Column) -> Column:
    """A path without dot segments; a last one leaves its slash."""
    here, up = (lambda s: F.lower(s).isin(".", "%2e")), (lambda s: F.lower(s).isin("..", ".%2e", "%2e.", "%2e%2e"))
    parts = F.split(F.regexp_replace(path, r"^[/\\]", ""), r"[/\\]")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, s: F.when(up(s), F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))))
                       .when(here(s), a).otherwise(F.array_append(a, s)))
    last = F.element_at(parts, -1)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when((here(last) | up(last)) & (F.size(kept) > 0), "/").otherwise(""))


def _numeric(host: Column) -> tuple[Column, Column]:
    """Is the host's last label a number, and if so is the whole an IPv4 address?"""
    parts = F.split(host, r"\.")
    value = lambda p: (F.when(p.rlike("^0x[0-9a-f]*$"), F.conv(F.concat(F.lit("0"), F.substring(p, 3, 99)), 16, 10))
                       .when(p.rlike("^0[0-7]*$"), F.conv(p, 8, 10)).when(p.rlike("^[1-9][0-9]*$"), p)).try_cast("decimal(38,0)")
    n = F.size(parts)
    fits = F.forall(F.slice(parts, F.lit(1), n - 1), lambda p: F.coalesce(value(p) < 256, F.lit(False)))
    last = F.element_at(parts, -1)
    return last.rlike("^([0-9]+|0x[0-9a-f]*)$"), (n <= 4) & fits & F.coalesce(value(last) < F.pow(F.lit(256.0), F.lit(5) - n), F.lit(False))


def _split(df: DataFrame, value: str) -> DataFrame:
    """df with the parts of an address beside it, as columns `_a_...`; dropped by the callers."""
    v = F.col(value)
    df = df.withColumns({"_a_scheme": F.lower(F.regexp_extract(v, SCHEME, 1)), "_a_after": F.regexp_replace(v, SCHEME + r"[/\\]*", "")})
    df = df.withColumn("_a_authority", F.regexp_extract("_a_after", r"^[^/?#\\]*", 0))
    df = df.withColumns({"_a_rest": _from(F.col("_a_after"), F.char_length("_a_authority") + 1), "_a_user": F.regexp_extract("_a_authority", "^(.*)@", 1),
                         "_a_server": F.regexp_replace("_a_authority", "^.*@", "")})
    df = df.withColumns({"_a_port": F.regexp_extract("_a_server", r":([^:\]]*)$", 1), "_a_has_port": F.col("_a_server").rlike(r":[^:\]]*$"),
                         "_a_written": F.lower(F.regexp_replace("_a_server", r":[^:\]]*$", ""))})
    decoded = F.try_url_decode(F.replace("_a_written", F.lit("+"), F.lit("%2B")))
    df = df.withColumn("_a_full", F.when(F.instr("_a_written", "%") > 0, F.lower(decoded)).otherwise(F.col("_a_written")))
    df = df.withColumns({"_a_host": F.regexp_replace("_a_full", r"\.$", ""), "_a_fragment": F.regexp_extract("_a_rest", "(?s)#(.*)$", 1),
                         "_a_line": F.regexp_replace("_a_rest", "(?s)#.*$", "")})
    number, v4 = _numeric(F.col("_a_host"))
    df = df.withColumns({"_a_v6": F.col("_a_full").rlike(r"^\[[0-9a-f:.]+\]$"), "_a_number": number & (F.col("_a_host") != ""), "_a_v4": v4})
    bad_port = ~F.col("_a_port").rlike("^[0-9]*$") | F.coalesce(F.col("_a_port").try_cast("decimal(38,0)") > 65535, F.lit(False))
    broken = (F.coalesce(F.col("_a_full"), F.lit("")) == "") | (~F.col("_a_v6") & F.col("_a_full").rlike(_NO_HOST)) | (F.col("_a_number") & ~F.col("_a_v4")) | bad_port
    line = F.col("_a_line")
    return df.withColumns({"_a_broken": F.coalesce(broken, F.lit(True)), "_a_path": _escaped(_clean_path(F.regexp_extract(line, r"(?s)^[^?]*", 0)), _PATH_ESCAPED),
                           "_a_query": _escaped(F.regexp_extract(line, r"(?s)\?.*$", 0), _QUERY_ESCAPED)})


def _clear(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_a_")])


def with_request(df: DataFrame, column: str, out: str = "request") -> DataFrame:
    """df with a struct reason, url, scheme, hostname, domain, port, path of the address to be asked for.

    The first of thirteen refusals that holds is the reason, and then the rest is null; nothing is repaired but one
    dot after the host. A null value is blank. df must have no columns that begin with `_a_`.
    """
    a = lambda c: F.col(f"_a_{c}")
    df = _split(df.withColumn("_a_value", F.coalesce(trimmed(F.col(column)), F.lit(""))), "_a_value").withColumn("_a_suffix", suffix(a("host")))
    ours = a("scheme").isin(*PORTS)
    reason = (F.when(a("value") == "", "blank").when(a("value").rlike(WHITE), "interior_whitespace").when(~a("value").rlike(SCHEME), "scheme_missing")
              .when(a("scheme").isin(*HOSTED) & a("broken"), "unparsable").when(~ours, "scheme_not_http").when(~a("user").isin("", ":"), "userinfo_present")
              .when(a("fragment") != "", "fragment_present").when(a("host") == "", "host_empty").when(a("host").rlike(r"^\.|\.\.|\.$"), "host_empty_label")
              .when(a("v6") | a("number"), "host_is_ip_literal").when(F.instr(a("host"), ".") == 0, "host_without_dot")
              .when(a("suffix").isNull(), "no_icann_public_suffix").when(a("has_port"), "explicit_port"))
    df = df.withColumn("_a_reason", reason)
    ok = lambda c: F.when(a("reason").isNull(), c)
    name = F.substring(a("host"), F.lit(1), F.char_length(a("host")) - F.char_length(a("suffix")) - 1)
    path = F.concat(a("path"), F.when(a("query") != "?", a("query")).otherwise(""))
    fields = {"url": F.concat(a("scheme"), F.lit("://"), a("host"), a("path"), a("query")), "scheme": F.concat(a("scheme"), F.lit(":")), "hostname": a("host"),
              "domain": F.concat(F.element_at(F.split(name, r"\."), -1), F.lit("."), a("suffix")), "port": F.when(a("scheme") == "http", PORTS["http"]).otherwise(PORTS["https"]), "path": path}
    return _clear(df.withColumn(out, F.struct(a("reason").alias("reason"), *[ok(c).alias(k) for k, c in fields.items()])))


def with_resolved(df: DataFrame, page: str, href: str, out: str = "resolved") -> DataFrame:
    """df with the address that href means on page, without its fragment; null where there is none.

    Addresses of schemes without hosts (mailto and the like) stay as written. page must be an http or https address.
    """
    a = lambda c: F.col(f"_a_{c}")
    base = _split(df.withColumn("_a_page", trimmed(F.col(page))), "_a_page")
    origin = F.concat(a("scheme"), F.lit("://"), a("authority"))
    base = base.withColumns({"_b_scheme": a("scheme"), "_b_origin": F.when(a("scheme").isin(*PORTS) & ~a("broken"), origin), "_b_path": a("path"), "_b_query": a("query")})
    h = F.regexp_replace(F.regexp_replace(F.col(href), r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\n\r]", "")
    base = _clear(base).withColumn("_b_href", h)
    same = F.regexp_replace("_b_href", SCHEME, "")
    quirk = (F.lower(F.regexp_extract("_b_href", SCHEME, 1)) == F.col("_b_scheme")) & ~same.rlike(r"^[/\\]")
    base = base.withColumn("_b_href", F.when(quirk, same).otherwise(F.col("_b_href")))
    x, path = F.col("_b_href"), F.concat("_b_origin", "_b_path")
    whole = (F.when(x.rlike(SCHEME), x).when(x.rlike(r"^[/\\]{2}"), F.concat("_b_scheme", F.lit(":"), x)).when(x.rlike(r"^[/\\]"), F.concat(F.col("_b_origin"), x))
             .when(x.rlike(r"^\?"), F.concat(path, x)).when(x.rlike("^(#|$)"), F.concat(path, F.col("_b_query")))
             .otherwise(F.concat(F.regexp_replace(path, "[^/]*$", ""), x)))
    base = _split(base.withColumn("_a_value", F.when(F.col("_b_origin").isNotNull(), whole)), "_a_value")
    server = F.concat(a("full"), F.when((a("port") != "") & ~F.coalesce(a("port").try_cast("int") == F.when(a("scheme") == "http", 80).when(a("scheme") == "https", 443), F.lit(False)),
                                        F.concat(F.lit(":"), a("port").try_cast("int").cast("string"))).otherwise(""))
    user = F.when(a("user").isin("", ":"), "").otherwise(F.concat(a("user"), F.lit("@")))
    done = (F.when(~a("scheme").isin(*HOSTED), F.regexp_replace("_a_value", "(?s)#.*$", ""))
            .when(~a("broken"), F.concat(a("scheme"), F.lit("://"), user, server, a("path"), a("query"))))
    out_df = _clear(base.withColumn(out, done))
    return out_df.drop(*[c for c in out_df.columns if c.startswith("_b_")])


def redacted_target(href: Column) -> Column:
    """What a contact link is replaced by; null for other links."""
    t = trimmed(href)
    return F.when(t.rlike("(?i)^mailto:"), "[EMAIL]").when(t.rlike("(?i)^tel:"), "[PHONE]")
