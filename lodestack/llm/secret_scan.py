"""Secret scans in SQL functions only: fixed patterns plus a randomness test battery.

Base spans come from three patterns. Their places follow from what lies between
matches: ``split`` gives the gaps and ``regexp_extract_all`` the matches of the
same leftmost, non-overlapping search, so running lengths are start offsets. They
are summed in blocks of ``BLOCK`` matches, so a text of very many matches is not
copied once for each of them.

The method adds runs of encoding characters that look like keys, however long. A
run's encoding is inferred from its characters (hexadecimal, base 32 or base 64),
its characters become numbers below the alphabet's size, and four tests ask
whether they are uniform noise: a chi-squared test of eight equal parts of the
alphabet, a runs test around the alphabet's middle, a runs test of character
classes (capitals, small letters, digits, signs: names keep to one for long) and a
lag-one serial correlation. Fisher's method combines them to one p-value.

What is reported must be noise, so the false discoveries to control are runs of
structured text among those reported. Noise has uniform p-values; structured text
has small ones. In every class of length and encoding, the runs with p above
``UPPER`` tell how much noise the class has, and so how many runs of noise have a
p-value above any threshold; what lies above it beyond that number is structured.
A class reports the runs above the least threshold at which at most ``RATE`` of
them are structured by this estimate. Classes are apart because short runs of
text look more like noise than long ones and would borrow from them. Counts come
from all the corpus, as at most 8 classes x ``CELLS`` cells of p-values.

Defined cases: a null text is an empty one and has no spans; repeated rows get
equal spans; lengths and offsets are code points; added spans never overlap base
spans; a table without runs adds none, an empty table gives no rows; in a table
with very few runs, one alone is reported if its p-value is above ``UPPER``. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestack.session import cut

#: Kinds in listed order with their patterns.
ASSIGN = r"(?=[pPsStTaA])((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
HEX_LONG = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
RUN = r"[A-Za-z0-9+/_-]{24,}"
#: Alphabets in their encodings' order; - and _ stand for + and /.
ALPHABETS = {
    "hex": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: First value of each character class but the first.
CLASSES = {"hex": (10,), "base32": (26,), "base64": (26, 52, 62)}
PARTS = 8
RATE = 0.05
UPPER = 0.5
CELLS = 40
BLOCK = 256


SPAN = "struct<start:int,kind:int,end:int>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def placed(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """array<struct<start, kind, end>> of the matches that ``keep`` accepts; without it of all, with the match as ``hit``."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"))
    kind_of = SPAN if keep else SPAN.replace(">", ",hit:string>")
    none = F.array().cast(f"array<{kind_of}>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        fields = [start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")] + ([] if keep else [x["hit"].alias("hit")])
        wanted = x["hit"].isNotNull() & (keep(x["hit"]) if keep else F.lit(True))
        return F.struct(end.alias("at"), F.when(wanted, F.concat(state["out"], F.array(F.struct(*fields)))).otherwise(state["out"]).alias("out"))

    def block(state: Column, part: Column) -> Column:
        spans = F.aggregate(part, F.struct(state["at"].alias("at"), none.alias("out")), step)
        return let(spans, lambda s: F.struct(s["at"].alias("at"), F.concat(state["out"], F.array(s["out"])).alias("out")))

    def spans(matches: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(1), F.size(matches), F.lit(BLOCK)), lambda k: F.slice(matches, k, BLOCK))
        return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind_of}>>").alias("out")), block, lambda s: F.flatten(s["out"]))

    # Texts without any match, nearly all, are not split.
    return F.when(F.regexp_like(text, F.lit(pattern)), let(both, spans)).otherwise(none)


def is_assigned(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 12


def base_spans(text: Column) -> dict[str, Column]:
    return {
        "assign": placed(text, ASSIGN, 0, is_assigned),
        "access": placed(text, ACCESS, 1, lambda hit: F.length(hit) >= 18),
        # A run of 16 or more is one match of either pattern; asking for 16 at once skips short runs.
        "hex": placed(text, HEX_LONG, 2, lambda hit: F.length(hit) >= 16),
    }


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by a logistic approximation (absolute error below 2e-4)."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * z + 0.070566 * z * z * z)))


def chi_tail(x: Column, df: float) -> Column:
    """P(chi-squared > x) by the Wilson-Hilferty cube root."""
    c = 2.0 / (9.0 * df)
    return normal_tail((F.pow(x / df, 1 / 3) - (1 - c)) / c**0.5)


def encoding(run: Column) -> Column:
    mixed = run.rlike("[0-9]") & run.rlike("[A-Z]") & run.rlike("[a-z]")
    return (
        F.when(run.rlike("^([0-9A-F]+|[0-9a-f]+)$"), F.when(run.rlike("[A-Fa-f]") & run.rlike("[0-9]"), "hex"))
        .when(run.rlike("^[A-Z2-7]+$") & run.rlike("[2-7]") & run.rlike("[A-Z]"), "base32")
        .when(mixed, "base64")
    )


def battery(run: Column, kind: Column) -> Column:
    """Fisher's combined p-value that the run is uniform noise of its encoding."""
    size = F.when(kind == "hex", 16).when(kind == "base32", 32).otherwise(64)
    letters = F.when(kind == "hex", ALPHABETS["hex"]).when(kind == "base32", ALPHABETS["base32"]).otherwise(ALPHABETS["base64"])
    plain = F.when(kind == "hex", F.upper(run)).otherwise(F.translate(run, "-_", "+/"))
    values = F.filter(F.transform(F.split(plain, ""), lambda c: F.instr(letters, c) - 1), lambda v: v >= 0)

    def of_kind(value: Callable[[str], float]) -> Column:
        return F.when(kind == "hex", value("hex")).when(kind == "base32", value("base32")).otherwise(value("base64"))

    def power_sum(name: str, power: int) -> float:
        """Of the shares of the classes: the chance that so many characters are of one class."""
        ends = (0, *CLASSES[name], len(ALPHABETS[name]))
        return sum(((b - a) / ends[-1]) ** power for a, b in zip(ends, ends[1:]))

    starts = [of_kind(lambda name, i=i: (CLASSES[name] + (99, 99))[i]) for i in range(3)]
    class_of = lambda v: sum(((v >= s).cast("int") for s in starts), F.lit(0))

    def tests(x: Column) -> Column:
        """x: size of the alphabet, values and their classes, each computed once."""
        size, values = x["size"], x["values"]
        n = F.size(values).cast("double")
        parts = F.sequence(F.lit(0), F.lit(PARTS - 1))
        cells = F.transform(parts, lambda p: F.size(F.filter(values, lambda v: F.floor(v * PARTS / size) == p)))
        chi = F.aggregate(cells, F.lit(0.0), lambda s, c: s + (c - n / PARTS) * (c - n / PARTS) * PARTS / n)
        pairs = F.sequence(F.lit(1), F.size(values) - 1)
        high = lambda k: F.get(values, k) * 2 >= size
        runs = 1 + F.aggregate(pairs, F.lit(0), lambda s, k: s + (high(k) != high(k - 1)).cast("int")).cast("double")
        runs_z = F.abs(runs - (n + 1) / 2) / F.sqrt((n - 1) / 4)
        alike = F.aggregate(pairs, F.lit(0), lambda s, k: s + (F.get(x["classes"], k) == F.get(x["classes"], k - 1)).cast("int")).cast("double")
        two, three = x["two"], x["three"]
        alike_z = F.abs(alike - (n - 1) * two) / F.sqrt((n - 1) * two * (1 - two) + 2 * (n - 2) * (three - two * two))
        middle = (size - 1) / 2.0
        spread = (size * size - 1) / 12.0
        serial = F.aggregate(pairs, F.lit(0.0), lambda s, k: s + (F.get(values, k) - middle) * (F.get(values, k - 1) - middle))
        serial_z = F.abs(serial) / (spread * F.sqrt(n - 1))
        floor = F.lit(1e-300)
        found = (chi_tail(chi, PARTS - 1.0), 2 * normal_tail(runs_z), 2 * normal_tail(alike_z), 2 * normal_tail(serial_z))
        logs = [F.log(F.greatest(floor, p)) for p in found]
        return chi_tail(-2 * sum(logs[1:], logs[0]), 2.0 * len(logs))

    told = lambda vs: F.struct(size.alias("size"), vs.alias("values"), F.transform(vs, class_of).alias("classes"), of_kind(lambda k: power_sum(k, 2)).alias("two"), of_kind(lambda k: power_sum(k, 3)).alias("three"))
    return let(let(values, told), tests)


def without_assigned(text: Column) -> Column:
    """The text with kept assign spans blanked, every place as before."""
    both = F.arrays_zip(F.split(text, ASSIGN, -1).alias("gap"), F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)).alias("hit"))
    blank = lambda hit: F.when(is_assigned(hit), F.repeat(F.lit(" "), F.length(hit))).otherwise(F.coalesce(hit, F.lit("")))
    return F.when(F.regexp_like(text, F.lit(ASSIGN)), F.array_join(F.transform(both, lambda x: F.concat(x["gap"], blank(x["hit"]))), "")).otherwise(text)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, added): arrays of spans struct<start int, kind int, end int>, base sorted by start and kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    spans = base_spans(F.col("text"))
    base = F.array_sort(F.concat(*spans.values()))
    # Spans of the other two kinds lie whole in one run, so a run says itself whether it holds one.
    holds_base = lambda run: run.rlike(HEX_LONG) | run.rlike("AKIA[A-Z0-9]{14,}")
    runs = F.transform(placed(without_assigned(F.col("text")), RUN, 3), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("run"), encoding(x["hit"]).alias("enc")))
    tested = F.transform(
        F.filter(runs, lambda x: x["enc"].isNotNull() & ~holds_base(x["run"])),
        lambda x: F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            stratum(x["enc"], F.length(x["run"])).alias("stratum"),
            F.least(F.lit(CELLS - 1), F.floor(battery(x["run"], x["enc"]) * CELLS)).cast("int").alias("cell"),
        ),
    )
    seen = cut(rows.select("id", base.alias("base"), tested.alias("tested")))
    return seen.select(
        "id",
        "base",
        F.transform(
            F.filter("tested", lambda x: x["cell"] >= F.get(least_cells(seen), x["stratum"])),
            lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"), x["end"].alias("end")),
        ).alias("added"),
    )


def stratum(enc: Column, n: Column) -> Column:
    """Class of encoding (base 64 or another) and length (below 32, 48, 80, or longer)."""
    length = F.when(n < 32, 0).when(n < 48, 1).when(n < 80, 2).otherwise(3)
    return length + F.when(enc == "base64", 4).otherwise(0)


def least_cell(cells: list[int]) -> int:
    """The first cell above which at most RATE of a class's runs are structured; CELLS if it has no noise."""
    upper = int(UPPER * CELLS)
    noise = sum(cells[upper:]) / (1 - UPPER)
    for cell in range(int(RATE * CELLS), upper + 1):
        reported = sum(cells[cell:])
        if reported and reported - noise * (1 - cell / CELLS) <= RATE * reported:
            return cell
    return CELLS


def least_cells(seen: DataFrame) -> Column:
    counts = [[0] * CELLS for _ in range(8)]
    of = seen.select(F.explode("tested").alias("x")).groupBy("x.stratum", "x.cell").count()
    for r in of.collect():  # at most 8 x CELLS counts
        counts[r["stratum"]][r["cell"]] = r["count"]
    return F.array(*[F.lit(least_cell(cells)) for cells in counts])


def digest(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
