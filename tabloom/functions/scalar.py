"""Column functions used by the jobs; all of them are built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# fixed values: note names within an octave, starting at C
NOTE_NAMES = ["C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B"]
# fixed values: byte units
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB", "PB"]
NULL_TOKENS = ("NA", "?")
WHITESPACE = " \t\n\r\x0b\x0c"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null where the (string) column holds a missing-value token."""
    return F.when(~col(c).isin(*tokens), col(c))


def recode(c: str | Column, mapping: Mapping) -> Column:
    """Replace values by a small mapping; anything else becomes null."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*pairs)[col(c)]


def decode(c: str | Column, *pairs, default=None) -> Column:
    """Oracle style DECODE: null matches null."""
    out, c = F.lit(default), col(c)
    for value, result in reversed(list(zip(pairs[::2], pairs[1::2]))):
        out = F.when(c.eqNullSafe(F.lit(value)), F.lit(result)).otherwise(out)
    return out


def strip(c: str | Column) -> Column:
    """Trim every ASCII whitespace character, not only blanks."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def str_slice(c: str | Column, start: int, stop: int) -> Column:
    """Characters ``start`` (0-based) up to, not including, ``stop``."""
    return F.substring(col(c), start + 1, stop - start)


def after_prefix(c: str | Column, prefix: str) -> Column:
    """The trimmed rest after a prefix; null without the prefix."""
    c = col(c)
    return F.when(c.startswith(prefix), strip(F.substr(c, F.lit(len(prefix) + 1))))


def basename(c: str | Column) -> Column:
    return F.element_at(F.split(col(c), r"[/\\]"), -1)


def url_join(base: str | Column, c: str | Column) -> Column:
    """Resolve a link against a base URL (absolute, protocol, root, query or relative link)."""
    base, link = (F.lit(base) if isinstance(base, str) else base), col(c)
    scheme = F.regexp_extract(base, r"^([a-z][a-z0-9+.-]*:)", 1)
    host = F.regexp_extract(base, r"^([a-z][a-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(page == host, F.concat(host, F.lit("/"))).otherwise(F.regexp_replace(page, r"[^/]*$", ""))
    return (
        F.when(link == "", base)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(host, link))
        .when(link.startswith("?"), F.concat(page, link))
        .when(link.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), link))
        .otherwise(F.concat(folder, link))
    )


def hms(seconds: str | Column) -> Column:
    """Elapsed seconds as ``h:mm:ss.ss``."""
    s = col(seconds).cast("double")
    return F.format_string(
        "%d:%02d:%05.2f", F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60
    )


def human_size(c: str | Column) -> Column:
    """Byte count with the largest fitting unit (powers of 1024), two digits."""
    size = col(c).cast("double")
    out = None
    for i in reversed(range(len(BYTE_UNITS))):
        text = F.format_string(f"%.2f{BYTE_UNITS[i]}", F.bround(size / float(1024**i), 2))
        fits = F.abs(size) >= float(1024**i)
        out = F.when(fits, text) if out is None else out.when(fits, text)
    return out.when(size.isNotNull(), F.format_string("%.2fB", size))


def sigmoid(c: str | Column) -> Column:
    return 1 / (1 + F.exp(-col(c)))


def sigmoid_prime(c: str | Column) -> Column:
    return sigmoid(c) * (1 - sigmoid(c))


def elliot(c: str | Column) -> Column:
    return col(c) / (1 + F.abs(col(c)))


def note_number(freq: str | Column) -> Column:
    """MIDI number of a frequency, A4 = 440 Hz = 69."""
    return 69 + 12 * F.log2(col(freq) / 440.0)


def note_frequency(number: str | Column) -> Column:
    return 440 * F.pow(F.lit(2.0), (col(number) - 69) / 12.0)


def note_name(number: str | Column) -> Column:
    """Name and octave of the nearest note, e.g. 60 is C4."""
    n = F.bround(col(number)).cast("int")
    names = F.array(*[F.lit(x) for x in NOTE_NAMES])
    octave = (n / 12 - 1).cast("int")
    return F.concat(F.element_at(names, F.pmod(n, F.lit(12)).cast("int") + 1), octave.cast("string"))


def clip(c: str | Column, lo: float, hi: float) -> Column:
    return F.when(col(c).isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), col(c))))


def argmax(c: str | Column) -> Column:
    """0-based index of the first largest element."""
    return (F.array_position(col(c), F.array_max(col(c))) - 1).cast("int")


def thousands(c: str | Column, digits: int = 2) -> Column:
    return F.format_number(col(c), digits)


def fixed(c: str | Column, pattern: str = "%10.5f") -> Column:
    return F.format_string(pattern, col(c).cast("double"))


# fixed values: the published rational approximations of the normal quantile (algorithm AS 241), highest power first;
# the middle, the tails, and the far tails: numerator and denominator
NORMAL_QUANTILE = (
    ((2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4, 4.5921953931549871457e+4,
      1.3731693765509461125e+4, 1.9715909503065514427e+3, 1.3314166789178437745e+2, 3.3871328727963666080e+0),
     (5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4, 2.1213794301586595867e+4,
      5.3941960214247511077e+3, 6.8718700749205790830e+2, 4.2313330701600911252e+1, 1.0)),
    ((7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e+0,
      3.64784832476320460504e+0, 5.76949722146069140550e+0, 4.63033784615654529590e+0, 1.42343711074968357734e+0),
     (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
      6.89767334985100004550e-1, 1.67638483018380384940e+0, 2.05319162663775882187e+0, 1.0)),
    ((2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
      2.96560571828504891230e-1, 1.78482653991729133580e+0, 5.46378491116411436990e+0, 6.65790464350110377720e+0),
     (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
      1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0)),
)


def normal_tail_sql(p: str) -> str:
    """SQL of the distance from the nearer end that the outer approximations of ``normal_quantile_sql`` take."""
    return f"sqrt(-ln(least({p}, 1e0 - {p})))"


def normal_quantile_sql(p: str, tail: str) -> str:
    """SQL of the value that a standard normal variable stays below with probability ``p``; ``p`` and ``tail`` (``normal_tail_sql`` of it) are
    columns, so that neither is computed more than once."""
    def poly(coefficients: tuple, r: str) -> str:
        text = f"{coefficients[0]:.19e}"
        for c in coefficients[1:]:
            text = f"({text} * {r} + {c:.19e})"
        return text

    q = f"({p} - 5e-1)"
    ratio = lambda k, r: f"{poly(NORMAL_QUANTILE[k][0], r)} / {poly(NORMAL_QUANTILE[k][1], r)}"
    middle = f"{q} * {ratio(0, f'(1.80625e-1 - {q} * {q})')}"
    outer = f"(CASE WHEN {tail} <= 5e0 THEN {ratio(1, f'({tail} - 1.6e0)')} ELSE {ratio(2, f'({tail} - 5e0)')} END)"
    return f"CASE WHEN abs({q}) <= 4.25e-1 THEN {middle} ELSE sign({q}) * {outer} END"
