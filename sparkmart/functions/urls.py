"""URL / DSN decomposition built from regular expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkmart.functions._util import col

__all__ = ["URL_RE", "url_parts", "url_param", "url_absolutise", "default_port", "keep_image_url"]

# scheme, user, password, host, port, path, query, fragment
URL_RE = (r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://(?:([^:@/?#]*)(?::([^@/?#]*))?@)?"
          r"([^:/?#]*)(?::([0-9]+))?)?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$")


def default_port(scheme) -> Column:
    """Fixed defaults of the reference: mysql / mariadb 3306, postgres / pg 5432."""
    s = F.lower(col(scheme))
    return (F.when(s.startswith("mysql") | s.startswith("mariadb"), F.lit(3306))
            .when(s.startswith("postgres") | s.startswith("pg"), F.lit(5432)))


def _nz(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def url_parts(c) -> Column:
    """Struct(scheme, user, password, host, port, database, query) of a URL or
    DSN. A scheme-less 'user:pass@host:port/db' is read as if it had the scheme
    'dummy'. User / password / database are percent-decoded; the database is the
    first path segment."""
    raw = col(c)
    fixed = F.when(~raw.contains("://") & raw.contains("@") & ~raw.startswith("//"),
                   F.concat(F.lit("dummy://"), raw)).otherwise(raw)

    def g(i):
        return F.regexp_extract(fixed, URL_RE, i)

    scheme = _nz(g(1))
    port = F.coalesce(_nz(g(5)).try_cast("int"), default_port(scheme))
    db = _nz(F.regexp_extract(F.try_url_decode(F.regexp_replace(g(6), "^/+", "")), r"^([^/]*)", 1))
    return F.struct(
        scheme.alias("scheme"),
        _nz(F.try_url_decode(g(2))).alias("user"),
        _nz(F.try_url_decode(g(3))).alias("password"),
        F.lower(_nz(g(4))).alias("host"),
        port.alias("port"),
        db.alias("database"),
        _nz(g(7)).alias("query"),
    )


def url_param(c, name: str) -> Column:
    """First non-blank value of query parameter ``name`` (percent-decoded)."""
    q = F.regexp_extract(col(c), r"\?([^#]*)", 1)
    v = F.regexp_extract(q, r"(?:^|&)" + name + r"=([^&]*)", 1)
    return _nz(F.try_url_decode(v))


def url_absolutise(u, base) -> Column:
    """Resolve ``u`` against ``base``: absolute http(s), 'data:' and '//' are
    kept; '/x' joins the origin; '?q' / '#f' replace those parts; anything else
    joins the base's directory."""
    u, b = col(u), col(base)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    no_frag = F.regexp_replace(b, "#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    directory = F.regexp_extract(no_query, r"^(.*/)", 1)
    directory = F.when(directory == F.concat(origin, F.lit("")), F.concat(origin, F.lit("/"))) \
        .when(F.length(directory) <= F.length(origin), F.concat(origin, F.lit("/"))) \
        .otherwise(directory)
    return (F.when(u.isNull() | (u == ""), F.lit(None).cast("string"))
            .when(u.startswith("http://") | u.startswith("https://") | u.startswith("data:")
                  | u.startswith("//"), u)
            .when(u.startswith("/"), F.concat(origin, u))
            .when(u.startswith("?"), F.concat(no_query, u))
            .when(u.startswith("#"), F.concat(no_frag, u))
            .otherwise(F.concat(directory, F.regexp_replace(u, r"^\./", ""))))


def keep_image_url(u) -> Column:
    """Image URL filter: non-empty, not a '.gif', not an inline 'data:' URI."""
    v = col(u)
    return v.isNotNull() & (v != "") & ~F.lower(v).endswith(".gif") & ~v.startswith("data:")
