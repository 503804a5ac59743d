"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, Spark functions only.

A text is the set of its piece digests. Every line is cut after sentence ends, and a sentence longer than
``LONG`` characters after the words where a hash of the word and the one before fits (about every ``EVERY``-th);
a sentence with a run of more than ``LONG_WORD`` characters without a space is cut by its characters, so that texts in scripts
without spaces are cut, too; a piece without such a place is cut every ``MOST`` characters. Cuts depend on nearby content only.

A sketch has blocks of three parts of cells; a digest's bits name its block and one cell in each part. A cell holds a count, the XOR
of its digests and the XOR of their check hashes. The fingerprint is the sketch of ``BLOCKS`` blocks, in hexadecimal.

Two sketches are subtracted cell by cell: common digests cancel. Peeling then recovers the differing digests: a cell with
count +-1 whose check fits names one, which is taken out of its other cells, and so on. The number of differing digests is
estimated from those of one stratum (a sixteenth of the hash space) and the two sizes. Where the fingerprints can hold that many,
they are subtracted; else, or if cells stay, a sketch of as many blocks as fit the estimate is taken, and a block that does not peel is
retried with twice the cells and other hash seeds, until it does. The likeness is the Jaccard index that follows
from the recovered number: (a + b - d) / (a + b + d). Each text is cut once; a row's neighbour brings its digests along.

The neighbour in id order is found without a global sort: rows are dealt to ranges of (id, text digest) whose
bounds come from a bounded sample of the keys, about ``SPAN`` rows each, however dense the ids are. The next row
is a lead inside the range, and the last row of a range takes the first row of the next one that has rows (a
table with a row per range, at most ``RANGES``).

Defined cases: NULL and empty texts have no paragraphs; two such texts have likeness 1; NULL ids come first;
rows that repeat an id are ordered by a digest of the text, fully equal rows in any order; the last row's neighbour is
the first row; a single row is its own neighbour; extra columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 8            # cells of a block's part, at first
BLOCKS = 1          # blocks of the fingerprint
PER_BLOCK = 8       # differing digests aimed at per block
STRATA = 16         # strata of the hash space, one of which is compared for the estimate
TRIES = 40          # sizes of a block: doubled up to parts of 1024 cells, then other seeds
ROUNDS = 6          # peeling rounds per table (a deeper one is retried larger)
LONG = 80           # characters from which a sentence is cut further
LONG_WORD = 32      # characters from which a word is cut between its characters
EVERY = 16          # words (or characters) between two such cuts, on average
MOST = 512          # characters without a cut, at most
SPAN = 64           # rows per range, as long as that makes no more than RANGES
RANGES = 4096       # ranges of ids, at most
SAMPLE = 1 << 16    # keys the bounds are taken from, about

_CUT = "\ufdd0"     # marks a cut inside a sentence (a noncharacter; in a text it counts as a cut)


def _cut(piece: Column) -> Column:
    """A piece cut at content-defined places: marked after the units whose hash fits, joined and split again."""

    def marked(units: Column, between: str) -> Column:
        return F.transform(F.array(units), lambda us: F.array_join(F.transform(us, lambda u, i: F.when(
            F.xxhash64(F.get(us, i - 1), u).bitwiseAND(F.lit(EVERY - 1)) == 0, F.concat(u, F.lit(_CUT))).otherwise(u)), between))[0]

    by_words, by_characters = marked(F.split(piece, " "), " "), marked(F.split(piece, ""), "")
    return F.split(F.when(piece.rlike(f"[^ ]{{{LONG_WORD + 1}}}"), by_characters).otherwise(by_words), _CUT)


def digests(text: Column) -> Column:
    """Distinct piece digests of a text."""
    ended = F.coalesce(text, F.lit(""))
    for end in (". ", "! ", "? ", "。", "！", "？"):
        ended = F.replace(ended, F.lit(end), F.lit(end.rstrip() + "\n"))
    sentences = F.split(ended, "\n")
    cut = F.flatten(F.transform(sentences, lambda p: F.when(F.char_length(p) > LONG, _cut(p)).otherwise(F.array(p))))
    short = F.flatten(F.transform(cut, lambda p: F.when(F.char_length(p) > MOST, F.regexp_extract_all(
        p, F.lit(f"(?s)(.{{1,{MOST}}})"), 1)).otherwise(F.array(p))))
    return F.array_distinct(F.transform(F.filter(short, lambda p: p != ""), lambda p: F.xxhash64(p)))


# Pieces of SQL: lambda variables stand for rows' arrays (an array of one is a let), so every part is evaluated once per row.

def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _entry(digest: str, part: str, seed: str, sign: str) -> str:
    """A digest with its check hash and its cell in each part, all from one hash."""
    places = ", ".join(f"'p{j}', cast(shiftright(z, {10 * j}) & ({part} - 1) as int)" for j in range(3))
    return _let("z", f"xxhash64({digest}, {seed})", f"named_struct('s', {sign}, 'd', {digest}, 'c', shiftrightunsigned(z, 32), {places})")


def _filled(entries: str, part: str) -> str:
    """The cells of entries, part by part."""
    parts = [f"transform(sequence(0, {part} - 1), i -> aggregate(filter(es, e -> e.p{j} = i), "
             f"named_struct('n', 0, 'k', 0L, 'h', 0L), (a, e) -> named_struct('n', a.n + e.s, 'k', a.k ^ e.d, 'h', a.h ^ e.c)))" for j in range(3)]
    return _let("es", entries, f"concat({', '.join(parts)})")


def _block(digest: str, blocks: str) -> str:
    return f"pmod(shiftright({digest}, 32), {blocks})"


def _difference(left: str, right: str) -> str:
    """Cell-wise subtraction of two tables."""
    return f"zip_with({left}, {right}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 'h', x.h ^ y.h))"


def _peeled(cells: str, part: str, seed: str) -> str:
    """Digests recovered from the cells of one block's difference, NULL when cells are left over."""
    cell = _entry("u.k", part, seed, "u.n")
    pure = (f"transform(array_distinct(transform(filter(st.cells, c -> abs(c.n) = 1 and shiftrightunsigned(xxhash64(c.k, {seed}), 32) = c.h), "
            f"c -> named_struct('k', c.k, 'n', c.n))), u -> {cell})")
    parts = [f"transform(slice(st.cells, {j} * {part} + 1, {part}), (c, i) -> aggregate(filter(ps, p -> p.p{j} = i), c, (a, p) -> "
             f"named_struct('n', a.n - p.s, 'k', a.k ^ p.d, 'h', a.h ^ p.c)))" for j in range(3)]
    taken = f"concat({', '.join(parts)})"
    step = _let("ps", pure, f"if(size(ps) = 0, named_struct('go', false, 'cells', st.cells, 'found', st.found), named_struct('go', true, "
                            f"'cells', {taken}, 'found', concat(st.found, transform(ps, p -> p.d))))")
    run = (f"aggregate(sequence(1, {ROUNDS}), named_struct('go', true, 'cells', {cells}, 'found', cast(array() as array<bigint>)), "
           f"(st, r) -> if(st.go, {step}, st))")
    return _let("w", run, "if(forall(w.cells, c -> c.n = 0 and c.k = 0 and c.h = 0), w.found, null)")


def _signed(part: str, seed: str) -> str:
    """Entries of a block's two digest lists: the right one is subtracted."""
    return f"concat(transform(x.a, d -> {_entry('d', part, seed, '1')}), transform(x.b, d -> {_entry('d', part, seed, '-1')}))"


def _larger(left: str, right: str, estimate: str) -> str:
    """Differing digests by a sketch of as many blocks as the estimate asks for, each retried larger until it peels.

    Digests are dealt to blocks in two steps (about the square root of their number each), so p digests cost
    p * sqrt(p) tests, not p * p."""
    def tried(part: str, seed: str) -> str:
        return _peeled(_filled(_signed(part, seed), part), part, seed)

    again = (f"aggregate(sequence(1, {TRIES}), cast(null as array<bigint>), (f, t) -> coalesce(f, "
             + _let("q", f"cast(shiftleft({PART}, least(t, 8)) as int)", tried("q", "t")) + "))")
    fine = (f"flatten(transform(sequence(0, m - 1), i2 -> " + _let("x", f"named_struct("
            f"'a', filter(v.a, d -> pmod(shiftright(d, 24), m) = i2), 'b', filter(v.b, d -> pmod(shiftright(d, 24), m) = i2))",
            f"coalesce({tried(str(PART), '0')}, {again})") + "))")
    coarse = (f"flatten(transform(sequence(0, m - 1), i1 -> " + _let("v", f"named_struct("
              f"'a', filter({left}, d -> {_block('d', 'm')} = i1), 'b', filter({right}, d -> {_block('d', 'm')} = i1))", fine) + "))")
    return _let("m", f"cast(ceil(sqrt(greatest(1, {estimate}) / {PER_BLOCK}D)) as int)", coarse)


def _estimate(left: str, right: str) -> str:
    """About the number of differing digests."""
    stratum = [f"filter({x}, d -> d & {STRATA - 1} = 0)" for x in (left, right)]
    sampled = _let("u", f"named_struct('a', {stratum[0]}, 'b', {stratum[1]})",
                   "size(array_except(u.a, u.b)) + size(array_except(u.b, u.a))")
    return (f"least(size({left}) + size({right}), greatest(abs(size({left}) - size({right})), {STRATA} * {sampled}, "
            f"cast(sqrt(size({left}) + size({right})) as int)))")


def sketch(digest_array: str) -> Column:
    """The fingerprint's table of a digest column: its blocks' cells."""
    entries = f"transform(filter({digest_array}, d -> {_block('d', str(BLOCKS))} = number), d -> {_entry('d', str(PART), '0', '1')})"
    return F.expr(f"transform(sequence(0, {BLOCKS - 1}), number -> {_filled(entries, str(PART))})")


def fingerprint(cells: str, digest_array: str) -> Column:
    """The table as text: number of digests, then count, digest XOR and check XOR of each cell, at fixed width."""
    body = (f"array_join(transform(flatten({cells}), c -> concat(lpad(hex(c.n), 8, '0'), lpad(hex(c.k), 16, '0'), "
            f"lpad(hex(c.h), 8, '0'))), '')")
    return F.expr(f"concat(lpad(hex(size({digest_array})), 16, '0'), {body})")


def recovered(left: str, right: str, left_cells: str, right_cells: str) -> Column:
    """The differing digests of two digest columns, by subtracting and peeling their sketches."""
    direct = f"zip_with({left_cells}, {right_cells}, (lc, rc) -> {_peeled(_difference('lc', 'rc'), str(PART), '0')})"
    both = _let("f", direct, "if(exists(f, x -> x is null), null, flatten(f))")
    fits = f"est <= {BLOCKS * PER_BLOCK * 3 // 2}"
    return F.expr(_let("est", _estimate(left, right), f"coalesce(if({fits}, {both}, null), {_larger(left, right, 'est')})"))


def likeness(left: str, right: str, left_cells: str, right_cells: str) -> Column:
    """Jaccard index of two digest columns from the number of digests recovered."""
    total = F.expr(f"size({left}) + size({right})")
    return F.transform(F.array(F.size(recovered(left, right, left_cells, right_cells))), lambda d: F.when(
        total == 0, 1.0).otherwise((total - d).cast("double") / (total + d)))[0]


def _range_of(key: Column, bounds: list[tuple[bool, int, int]]) -> Column:
    """Number of the ascending ``bounds`` that are at most ``key``: binary search in an array literal."""
    if not bounds:
        return F.lit(0)
    places = F.expr("array({})".format(", ".join(
        f"named_struct('has', {str(h).lower()}, 'id', cast('{i}' as bigint), 'digest', cast('{d}' as bigint))" for h, i, d in bounds)))
    steps = F.expr("array({})".format(", ".join(str(1 << i) for i in reversed(range(len(bounds).bit_length())))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(places, at + step - 1) <= key, at + step).otherwise(at))


def ranged(docs: DataFrame) -> DataFrame:
    """ACTION (key sample): ``doc_id, text, k, b``: NULL texts as empty, the key that orders the rows, and its range."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.struct(
        F.col("doc_id").isNotNull().alias("has"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("id"),
        F.xxhash64(text).alias("digest")).alias("k"))
    n = rows.count()
    some = rows.filter(F.pmod(F.xxhash64("k"), F.lit(max(1, n // SAMPLE))) == 0).select("k.*").distinct().collect()  # at most two SAMPLE
    keys, ranges = sorted(map(tuple, some)), min(RANGES, -(-n // SPAN))
    bounds = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []
    return rows.withColumn("b", _range_of(F.col("k"), bounds))


def with_next(docs: DataFrame) -> DataFrame:
    """ACTION: ``doc_id, text, a, ta, next`` (NULL texts as empty; ``a``, ``ta``: digests and sketch of the text; ``next``: these
    three of the neighbour in ascending doc_id)."""
    rows = ranged(docs)

    def described(texts: DataFrame, name: str) -> DataFrame:
        return texts.withColumn("a", digests(F.col("text"))).withColumn("ta", sketch("a")).withColumn(name, F.struct("text", "a", "ta"))

    whole = described(rows, "own")
    # first row of each range, and the range it follows (one row per range)
    firsts = rows.groupBy("b").agg(F.min(F.struct("k", "text")).alias("f")).select("b", F.col("f.text").alias("text"))
    firsts = described(firsts, "first").select("b", "first")
    heads = rows.select("b").distinct()
    everything = Window.orderBy("b")
    chain = heads.select(F.col("b").alias("of"), F.coalesce(F.lead("b").over(everything), F.first("b").over(everything)).alias("b"))
    after = chain.join(firsts, "b").select(F.col("of").alias("b"), "first")
    inside = whole.withColumn("next", F.lead("own").over(Window.partitionBy("b").orderBy("k", "own.text")))
    return inside.join(after, "b").select("doc_id", "own.text", "own.a", "own.ta", F.coalesce("next", "first").alias("next"))


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last quarter (code points, rounded down) replaced by as many of ``following``'s first."""
    n = F.floor(F.char_length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - n), F.substring(following, F.lit(1), n))


def fingerprints(docs: DataFrame) -> DataFrame:
    """ACTION. ``docs(doc_id, text)`` to ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``: likeness of each text to its edited version and to the next document."""
    staged = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next.text")))
    parts = staged.select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                          "a", "ta", digests(F.col("edited")).alias("e"), F.col("next.a").alias("x"), F.col("next.ta").alias("tx"))
    tables = parts.withColumn("te", sketch("e"))
    return tables.select("doc_id", "n_chars", "edited_sha256", fingerprint("ta", "a").alias("fingerprint"),
                         fingerprint("te", "e").alias("edited_fingerprint"), likeness("a", "e", "ta", "te").alias("near_edited"),
                         likeness("a", "x", "ta", "tx").alias("near_next"))
