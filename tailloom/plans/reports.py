"""Queries over the adapter views, each with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import classify_tail, precursor_of
from ..operators import counting, differential, folding, intervals, profiles, regions, sequences, tags as tag_ops, targets, views
from ..storage import written
from . import adapters

#: Tags under so many parts per million are left out of the reports.  The views' tags are single rows, whose ppm falls as
#: tables grow, so the reports take all of them; ``isoform_counts_floor`` shows the floor.
FLOOR = 0.0
REPEATS = [("rmsk", True, "exact")]
SLOTS = {"gene": "miRNA", "mirtron": "mirtron", "trna": "tRNA", "linc": "lincRNA", "rmsk": "rmsk"}


class Base:
    """The stages that the reports share.

    Tags, their samples' weights, annotated tags and the fact table are written once for a session, a folder and its
    files' state, and all reports read them.
    """

    TABLES = ("lineitem", "part")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.kept, self.wide = spark, sf_dir, {}, None

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Base":
        """The session's stages over a folder, made anew if its files have changed."""
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{sf_dir}/{t}.parquet" for t in cls.TABLES])
        state = sorted(tuple(r) for r in files.select("path", "modificationTime", "length").collect())  # a row for each file
        stages = spark.__dict__.setdefault("_tailloom_stages", {})
        if stages.get((cls, sf_dir), (None,))[0] != state:
            stages[cls, sf_dir] = state, cls(spark, sf_dir)
        return stages[cls, sf_dir][1]

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.kept:
            self.kept[name] = written(build())
        return self.kept[name]

    def view(self, sql: str) -> DataFrame:
        """An adapter view; ids that pass 63 bits, where the SQL's sums overflow, are decimals."""
        if adapters.KEY not in sql:
            return adapters.view(self.spark, self.sf_dir, sql)
        if self.wide is None:
            self.wide = adapters.wide_ids(self.spark, self.sf_dir)
        return adapters.view(self.spark, self.sf_dir, sql, self.wide)

    def source_tags(self) -> DataFrame:
        inside = F.col("mismatch_pos").between(1, 7)
        base = F.substring("seq", F.col("mismatch_pos") + 1, F.lit(1))
        marked = F.when(inside, F.concat((F.col("mismatch_pos") - 1).cast("string"), base)).otherwise("")
        return self.view(adapters.TAGS).withColumn("seed_md", marked)

    def tags(self) -> DataFrame:
        source = self.once("tags", self.source_tags)  # written first: else they would be made twice, also for the samples' weights
        return tag_ops.normalize_ppm(source, self.once("weights", lambda: tag_ops.sample_weights(source)))

    def features(self) -> DataFrame:
        return self.view(adapters.FEATURES)

    def hits(self) -> DataFrame:
        return intervals.assign_arm(intervals.annotate_intervals(self.tags(), self.features()))

    def annotated_flags(self) -> DataFrame:
        """annotated, with is_flagged: whether the tag also hits a repeat."""
        kept = [*self.tags().columns, "biotype", "anno", "is_flagged"]
        return self.once("annotated", lambda: self.prime_rows().select(*kept)).where(F.col("ppm") >= FLOOR)

    def annotated(self) -> DataFrame:
        """Tags with the biotype and name (anno) of each hit of their first biotype."""
        return self.annotated_flags().drop("is_flagged")

    def prime_rows(self) -> DataFrame:
        """Hits of each tag's first biotype; where tags are no longer than a bin, their hits are not shuffled to find it."""
        longest = self.tags().agg(F.max(F.col("t_end") - F.col("t_start"))).first()[0] or 0  # one number
        if longest > intervals.BIN:
            return counting.prime_hits(self.hits(), rules=REPEATS)
        hits = intervals.assign_arm(intervals.annotate_starts(self.tags(), self.features(), longest))
        return counting.prime_hits(hits, dealt=("chrom", "strand", "_bin"), rules=REPEATS)

    def prime(self) -> DataFrame:
        return self.annotated().select("tag_id", "biotype", F.col("anno").alias("name"))

    def prioritized(self) -> DataFrame:
        """prime with the tags that have no hit, as un_annotated."""
        return counting.prioritize_biotype(self.tags(), self.hits().select("tag_id", "biotype", "name"))

    def iso(self) -> DataFrame:
        return self.once("iso", lambda: counting.isoform_facts(self.annotated()))

    def counts(self) -> DataFrame:
        return self.once("counts", lambda: counting.biotype_counts(self.tags(), self.prioritized(), FLOOR))

    def flagged(self) -> DataFrame:
        return counting.flag_isoform(self.annotated_flags())

    def marks(self) -> DataFrame:
        return counting.isoform_marks(self.iso(), self.flagged())

    def seeded(self) -> DataFrame:
        """annotated, with the marked seed."""
        rows = self.annotated()
        return rows.withColumn("seed", counting.marked_seed(rows))

    def totals(self) -> DataFrame:
        return profiles.annotation_totals(self.iso())

    def measures(self) -> DataFrame:
        return counting.measure_table(self.iso(), "anno")

    def measure_folds(self) -> DataFrame:
        return profiles.pairwise_fold(self.measures(), ("measure", "anno"))

    def assembled(self) -> DataFrame:
        """Features as if from files of their own; mirtrons are longer, so that some meet miRNAs, and tRNAs have another biotype."""
        end = F.when(F.col("biotype") == "mirtron", F.col("f_end") + 300).otherwise(F.col("f_end"))
        f = self.features().select("chrom", "f_start", end.alias("f_end"), "strand", "biotype", "name")
        trna = f.where("biotype = 'tRNA'").withColumn("biotype", F.lit("Mt_tRNA"))
        return intervals.assemble_features(f.where("biotype IN ('miRNA', 'lincRNA')"), f.where("biotype = 'mirtron'"), f.where("biotype = 'rmsk'"), trna)

    def other_hits(self) -> DataFrame:
        """Hits whose repeats stand for mirbase."""
        return self.hits().withColumn("biotype", F.when(F.col("biotype") == "rmsk", "mirbase").otherwise(F.col("biotype")))

    def folds(self) -> DataFrame:
        return differential.with_p(profiles.pairwise_fold(self.totals()))

    def iso_folds(self) -> DataFrame:
        return differential.with_p(profiles.pairwise_fold(self.iso_totals()))

    def tails(self) -> DataFrame:
        """annotated, with tail_class and read_len."""
        return self.annotated().withColumns({"tail_class": classify_tail(F.col("tail")), "read_len": F.col("gm_len")})

    def iso_totals(self) -> DataFrame:
        """totals by isoform, as name_seed."""
        return profiles.annotation_totals(self.iso().withColumn("anno", F.concat_ws("_", "anno", "seed")))

    def mir_hits(self) -> DataFrame:
        """Hits of miRNAs and mirtrons, with mir and whether the tag also hits a repeat."""
        hits = self.hits()
        flags = counting.label_rules(hits, REPEATS)
        kept = hits.where(F.col("biotype").isin("miRNA", "mirtron") & (F.col("ppm") >= FLOOR))
        return kept.withColumn("mir", precursor_of(F.col("name"))).join(flags, "tag_id")

    def predictions(self) -> DataFrame:
        return targets.join_targets(self.view(adapters.TARGETS), self.totals().select(F.col("anno").alias("mir"), "anno"))

    def folded(self) -> DataFrame:
        digits = F.transform(F.split("entropy", ""), lambda x: x.cast("double"))
        return self.view(adapters.FOLDS).select("name", F.col("pre_start").alias("start"), F.col("pre_end").alias("end"), digits.alias("entropy"))

    def precursor_reads(self) -> DataFrame:
        return self.annotated().where(F.col("biotype").isin("miRNA", "mirtron")).drop("biotype")

    def genome(self) -> DataFrame:
        return self.view(adapters.GENOME)

    def genome_reads(self) -> DataFrame:
        """The tags' reads as the genome has them, with their tails."""
        at = self.tags().withColumn("at", F.col("t_start") - 1)
        return sequences.extract_sequence(at, self.genome(), "at", "gm_len", adapters.CHUNK, "tail").select(F.col("sequence").alias("seq"))

    def alignments(self) -> DataFrame:
        return self.view(adapters.ALIGNMENTS)


_CTES = {
    "alignments": adapters.ALIGNMENTS,
    "variants": adapters.VARIANTS,
    "features": adapters.FEATURES,
    "genome": adapters.GENOME,
    "tags0": adapters.TAGS,
    "tags": "SELECT t.*, CAST(reads AS DOUBLE) / nh AS weight, (CAST(reads AS DOUBLE) / nh) * 1e6 / sum(CAST(reads AS DOUBLE) / nh) OVER (PARTITION BY sample) AS ppm FROM tags0 t",
    "hits0": "SELECT t.*, f.db_idx, f.f_start, f.f_end, f.biotype, f.name FROM tags t JOIN features f ON t.chrom = f.chrom AND t.strand = f.strand AND t.t_start - 1 < f.f_end AND t.t_end - 1 > f.f_start",
    "hits": "SELECT * REPLACE (CASE WHEN biotype IN ('miRNA', 'mirtron') AND NOT regexp_matches(name, '-[35]p$') THEN name || CASE WHEN (strand = '+') = (t_start + t_end > f_start + f_end) THEN '-3p' ELSE '-5p' END ELSE name END AS name) FROM hits0",
    "ranked": "SELECT *, CASE biotype WHEN 'miRNA' THEN 1 WHEN 'mirtron' THEN 2 WHEN 'tRNA' THEN 3 WHEN 'lincRNA' THEN 4 END AS rk FROM hits",
    "prime": "SELECT tag_id, biotype, name FROM (SELECT *, min(rk) OVER (PARTITION BY tag_id) AS best FROM ranked WHERE rk IS NOT NULL) x WHERE rk = best",
    "annotated": f"SELECT t.*, p.biotype, p.name AS anno, translate(substring(t.seq, 2, 7), 'T', 'U') AS seed, t.gm_len AS read_len, CASE WHEN tail = '' THEN 'GM' WHEN tail = 'A' THEN 'A' WHEN tail = 'C' THEN 'C' WHEN tail = 'G' THEN 'G' WHEN tail = 'TT' THEN 'U' ELSE 'Other' END AS tail_class FROM tags t JOIN prime p ON t.tag_id = p.tag_id WHERE t.ppm >= {FLOOR}",
    "iso": "SELECT sample, biotype, anno, seed || CASE WHEN mismatch_pos BETWEEN 1 AND 7 THEN '|' || CAST(mismatch_pos - 1 AS VARCHAR) || translate(substring(seq, mismatch_pos + 1, 1), 'T', 'U') ELSE '' END AS seed, tail_class, read_len, sum(ppm) AS ppm FROM annotated GROUP BY ALL",
    "counts": f"SELECT sample, biotype, tail_class, read_len, sum(ppm) AS ppm FROM (SELECT sample, biotype, tail_class, read_len, ppm FROM annotated UNION ALL SELECT sample, 'un_annotated', CASE WHEN tail = '' THEN 'GM' WHEN tail = 'A' THEN 'A' WHEN tail = 'C' THEN 'C' WHEN tail = 'G' THEN 'G' WHEN tail = 'TT' THEN 'U' ELSE 'Other' END, gm_len, ppm FROM tags t WHERE ppm >= {FLOOR} AND NOT EXISTS (SELECT 1 FROM hits h WHERE h.tag_id = t.tag_id)) x GROUP BY ALL",
    "targets": adapters.TARGETS,
    "folds": adapters.FOLDS,
    "isototals": "SELECT sample, anno || '_' || seed AS anno, round(sum(ppm), 6) AS ppm FROM iso GROUP BY ALL",
    "mirhits": f"SELECT *, regexp_replace(name, '-[35]p$', '') AS mir FROM (SELECT *, bool_or(biotype = 'rmsk') OVER (PARTITION BY tag_id) AS is_flagged FROM hits) x WHERE biotype IN ('miRNA', 'mirtron') AND ppm >= {FLOOR}",
    "genomereads": f"SELECT CASE WHEN strand = '-' THEN reverse(translate(bases, 'ACGT', 'TGCA')) ELSE bases END || tail AS seq FROM (SELECT strand, tail, substring(chunk, CAST((t_start - 1) % {adapters.CHUNK} + 1 AS INT), gm_len) AS bases FROM tags0 t JOIN genome g ON g.chrom = t.chrom AND g.chunk_id = (t_start - 1) // {adapters.CHUNK}) x",
    "windows": f"SELECT chrom, chunk_id * {adapters.CHUNK} + i AS ofs, substring(chunk, CAST(i AS INT) + 1, {sequences.LONGEST}) AS w FROM (SELECT *, unnest(range({adapters.CHUNK})) AS i FROM genome) x UNION ALL SELECT chrom, 0, left(chunk, CAST(i AS INT)) FROM (SELECT *, unnest(range(12, {sequences.LONGEST})) AS i FROM genome WHERE chunk_id = 0) y",
    "sites": f"SELECT *, left(template, 12) AS kmer FROM (SELECT chrom, ofs, '+' AS strand, w AS template FROM windows WHERE length(w) = {sequences.LONGEST} UNION ALL SELECT chrom, ofs, '-', reverse(translate(w, 'ACGT', 'TGCA')) FROM windows) x WHERE length(template) >= 12",
    "predictions": "SELECT DISTINCT mir AS anno, translate(seed, 'U', 'T') AS seed, gene, pct FROM targets WHERE mir IN (SELECT anno FROM totals)",
    "folded": "SELECT a.*, pre_start, pre_end, entropy, CASE WHEN strand = '-' THEN pre_end + 1 - t_end ELSE t_start - pre_start - 1 END AS place FROM annotated a JOIN folds f ON f.name = regexp_replace(a.anno, '-[35]p$', '') WHERE biotype IN ('miRNA', 'mirtron') AND t_start >= pre_start + 1 AND t_end <= pre_end + 1",
    "totals": "SELECT sample, anno, round(sum(ppm), 6) AS ppm FROM iso GROUP BY ALL",
}
_NEEDS = {"genomereads": ["tags0", "genome"], "windows": ["genome"], "sites": ["windows"], "tags": ["tags0"], "hits0": ["tags", "features"], "hits": ["hits0"], "ranked": ["hits"], "prime": ["ranked"], "annotated": ["tags", "prime"], "iso": ["annotated"], "counts": ["annotated", "hits"], "totals": ["iso"], "isototals": ["iso"], "mirhits": ["hits"], "predictions": ["targets", "totals"], "folded": ["annotated", "folds"]}


def _with(sql: str, names: tuple[str, ...], ctes: dict[str, str] = _CTES, needs: dict[str, list[str]] = _NEEDS) -> str:
    """sql over the named common table expressions and those they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in needs.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "WITH " + ", ".join(f"{n} AS ({ctes[n].strip()})" for n in order) + " " + sql


#: Added before rounding to four digits: values such as 62.03125 lie on a boundary, where engines may differ.
SHIFT = 3.7e-7


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + SHIFT, digits) for c, kind in df.dtypes if kind == "double"})


def _shifted(sql: str) -> str:
    """sql with SHIFT added inside each round(..., 4)."""
    out, at = [], 0
    while (begin := sql.find("round(", at)) >= 0:
        depth, end = 1, begin + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[begin + 6 : end - 1]
        value, _, digits = inner.rpartition(",")
        value = _shifted(value)
        out += [sql[at:begin], f"round(({value}) + {SHIFT},{digits})" if digits.strip() == "4" else f"round({value},{digits})"]
        at = end
    return "".join(out) + sql[at:]


_MEASURES = "round(sum(CASE WHEN tail_class = 'GM' THEN ppm ELSE 0 END), 4) AS gm, round(sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END), 4) AS pm, round(sum(ppm), 4) AS gmpm, round(CASE WHEN sum(ppm) < 1 THEN 0 ELSE sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END) * 100 / sum(ppm) END, 4) AS tailing"
_TAILS = ", ".join(f"round(sum(CASE WHEN tail_class = '{k}' THEN ppm ELSE 0 END), 4) AS {k.lower()}_tail" for k in ("A", "C", "G", "U", "Other"))
_PRE = "regexp_replace(anno, '-[35]p$', '')"
_ARM = "regexp_extract(anno, '-([35]p)$', 1)"
_FOLDS = "SELECT n.anno, s1, s2, coalesce(x.ppm, 0) AS x, coalesce(y.ppm, 0) AS y, (coalesce(x.ppm, 0) + 1) / (coalesce(y.ppm, 0) + 1) AS fold FROM (SELECT a.sample AS s1, b.sample AS s2 FROM (SELECT DISTINCT sample FROM totals) a, (SELECT DISTINCT sample FROM totals) b WHERE a.sample <> b.sample) p CROSS JOIN (SELECT DISTINCT anno FROM totals) n LEFT JOIN totals x ON x.anno = n.anno AND x.sample = s1 LEFT JOIN totals y ON y.anno = n.anno AND y.sample = s2 WHERE coalesce(x.ppm, 0) > 0 OR coalesce(y.ppm, 0) > 0"

_SHARES = ", ".join(f"sum(CASE WHEN tail_class = '{k}' THEN ppm ELSE 0 END) AS t_{k.lower()}" for k in ("A", "C", "G", "U", "Other", "GM"))
_AVERAGES = ", ".join(f"round(avg(t_{k} / t), 4) AS {k}" for k in ("a", "c", "g", "u", "other", "gm"))
_ISLANDS = "SELECT *, sum(new) OVER (PARTITION BY {by} ORDER BY t_start, t_end) AS island FROM (SELECT *, CASE WHEN coalesce(max(t_end) OVER (PARTITION BY {by} ORDER BY t_start, t_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) < t_start THEN 1 ELSE 0 END AS new FROM (SELECT {by}, t_start, t_end, sum(ppm) AS ppm FROM {rows} GROUP BY ALL) x) y"
_XY = "SELECT anno, sum(CASE WHEN sample = 'AF' THEN ppm ELSE 0 END) AS x, sum(CASE WHEN sample = 'RF' THEN ppm ELSE 0 END) AS y FROM totals WHERE sample IN ('AF', 'RF') GROUP BY anno"
_SEQUENCE = "CASE WHEN strand = '-' THEN reverse(translate({s}, 'ACGT', 'TGCA')) ELSE {s} END"

_ENDS = "SELECT a.sample, a.anno, sum(p * abs(e - mode)) / sum(p) AS h FROM (SELECT *, first_value(e) OVER (PARTITION BY sample, anno ORDER BY p DESC, e) AS mode FROM (SELECT sample, anno, {end} AS e, round(sum(ppm), 6) AS p FROM annotated GROUP BY ALL) x) a GROUP BY a.sample, a.anno"

_FIVE, _THREE = "CASE WHEN strand = '+' THEN t_start ELSE t_end END", "CASE WHEN strand = '+' THEN t_end ELSE t_start END"
_TAIL_END = "CASE WHEN strand = '+' THEN t_end + length(tail) ELSE t_start - length(tail) END"

_RANKS = "SELECT token, {keys}, CAST(s AS BIGINT) AS rank_sum, row_number() OVER (PARTITION BY token ORDER BY s DESC, {back}) AS place FROM (SELECT token, {keys}, sum(r) AS s FROM (SELECT *, row_number() OVER (PARTITION BY token, sample ORDER BY v, {keys}) AS r FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS token, sample, {{keys}}, {v} AS v FROM iso GROUP BY sample, {{keys}}"
    for t, v in [("gmpm", "round(sum(ppm), 6)"), ("gm", "round(sum(CASE WHEN tail_class = 'GM' THEN ppm ELSE 0 END), 6)"), ("pm", "round(sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END), 6)"), ("tailing", "CASE WHEN sum(ppm) < 1 THEN 0 ELSE round(sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END) * 100 / sum(ppm), 6) END")]
) + ") x) y GROUP BY token, {keys}) z"
_MARKED = "seed || CASE WHEN mismatch_pos BETWEEN 1 AND 7 THEN '|' || CAST(mismatch_pos - 1 AS VARCHAR) || translate(substring(seq, mismatch_pos + 1, 1), 'T', 'U') ELSE '' END"
_TAIL_PROFILE = (
    ", ".join(f"round(CASE WHEN sum(pm) > 0 THEN {value} ELSE 0 END, 4) AS {name}" for name, value in [("gmpm", "sum(ppm)"), ("mean_tail_len", "sum(length(tail) * ppm) / sum(pm)"), ("tailing", "sum(pm) / sum(ppm)"), *((f"f_{k.lower()}", f"sum(CASE WHEN tail_class = '{k}' THEN ppm ELSE 0 END) / sum(pm)") for k in ("A", "C", "G", "U", "Other"))])
    + " FROM (SELECT *, CASE WHEN tail <> '' THEN ppm ELSE 0 END AS pm FROM annotated) x"
)

_PREFERENCES = f"SELECT anno, sample, kind FROM (SELECT anno, s1 AS sample, CASE WHEN count(*) FILTER (WHERE fold >= 1.2) = (SELECT count(DISTINCT sample) - 1 FROM totals) THEN 'UniLike' WHEN count(*) FILTER (WHERE fold <= 1 / 1.2) = (SELECT count(DISTINCT sample) - 1 FROM totals) THEN 'DisLike' END AS kind FROM ({_FOLDS}) f GROUP BY anno, s1) x WHERE kind IS NOT NULL"
_WHEN = {"GMPM": "TRUE", "GM": "tail_class = 'GM'", "PM": "tail_class <> 'GM'", **{k: f"tail_class = '{k}'" for k in ("A", "C", "G", "U", "Other")}}
_BY_MEASURE = " UNION ALL ".join(f"SELECT '{m}' AS measure, sample, {{keys}}, round(sum(ppm), 6) AS ppm FROM iso WHERE {test} GROUP BY ALL HAVING round(sum(ppm), 6) > 0" for m, test in _WHEN.items())
_MEASURE_FOLDS = f"SELECT n.measure, n.anno, s1, s2, coalesce(x.ppm, 0) AS x, coalesce(y.ppm, 0) AS y, (coalesce(x.ppm, 0) + 1) / (coalesce(y.ppm, 0) + 1) AS fold FROM (SELECT a.sample AS s1, b.sample AS s2 FROM (SELECT DISTINCT sample FROM iso) a, (SELECT DISTINCT sample FROM iso) b WHERE a.sample <> b.sample) p CROSS JOIN (SELECT DISTINCT measure, anno FROM ({_BY_MEASURE.format(keys='anno')}) m) n LEFT JOIN ({_BY_MEASURE.format(keys='anno')}) x ON x.measure = n.measure AND x.anno = n.anno AND x.sample = s1 LEFT JOIN ({_BY_MEASURE.format(keys='anno')}) y ON y.measure = n.measure AND y.anno = n.anno AND y.sample = s2 WHERE coalesce(x.ppm, 0) > 0 OR coalesce(y.ppm, 0) > 0"
_ASSEMBLED = "SELECT chrom, f_start, CASE WHEN biotype = 'mirtron' THEN f_end + 300 ELSE f_end END AS f_end, strand, biotype, CASE WHEN biotype = 'tRNA' THEN 'Mt_tRNA_' || name ELSE name END AS name FROM features f WHERE biotype <> 'miRNA' OR NOT EXISTS (SELECT 1 FROM features m WHERE m.biotype = 'mirtron' AND m.chrom = f.chrom AND m.strand = f.strand AND f.f_start <= m.f_end + 300 AND f.f_end >= m.f_start)"
#: Every annotation has a row for each sample here, 0 where it is absent.
_GRID = "SELECT a.anno, s.sample, coalesce(t.ppm, 0) AS ppm FROM (SELECT DISTINCT anno FROM {rows}) a CROSS JOIN (SELECT DISTINCT sample FROM {rows}) s LEFT JOIN {rows} t ON t.anno = a.anno AND t.sample = s.sample"
_LOADING = f"SELECT anno, sum(ppm) AS total, (max(ppm) - greatest(min(ppm), 1e-6)) / greatest(min(ppm), 1e-6) * CASE WHEN bool_or(sample NOT IN (hi, lo) AND CASE WHEN low > 0 THEN ppm >= 2 * low ELSE ppm > 0 END) THEN -1 ELSE 1 END AS diff, any_value(hi) AS max_sample, any_value(lo) AS min_sample FROM (SELECT *, min(ppm) OVER (PARTITION BY anno) AS low, first_value(sample) OVER (PARTITION BY anno ORDER BY ppm DESC, sample) AS hi, first_value(sample) OVER (PARTITION BY anno ORDER BY ppm, sample) AS lo FROM ({_GRID}) g) y GROUP BY anno"
#: Longest cluster that regions with a gap between them may come to share.
MERGE = 2000
_CLEAR = "(SELECT * FROM tags t WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.tag_id = t.tag_id)) z"
_WALK = (
    f"WITH RECURSIVE isles AS (SELECT sample, chrom, island, min(t_start) AS i_start, (min({{'s': t_start, 'e': t_end}})).e AS first_end, max(t_end) AS i_end, sum(ppm) AS ppm FROM ({_ISLANDS.format(by='sample, chrom', rows=_CLEAR)}) i GROUP BY sample, chrom, island), "
    f"walk AS (SELECT *, i_start AS head FROM isles WHERE island = 1 UNION ALL SELECT i.*, CASE WHEN i.first_end - w.head > {MERGE} THEN i.i_start ELSE w.head END FROM walk w JOIN isles i ON i.sample = w.sample AND i.chrom = w.chrom AND i.island = w.island + 1) "
    "SELECT sample, chrom, min(i_start) AS m_start, max(i_end) AS m_end, round(sum(ppm), 4) AS ppm FROM walk GROUP BY sample, chrom, head"
)


def _under(at: str, n: int) -> str:
    """Mean of n digits of entropy from a place, moved back from the end."""
    return "(" + " + ".join(f"CAST(substring(entropy, CAST(least({at}, length(entropy) - {n}) AS INT) + {i}, 1) AS DOUBLE)" for i in range(1, n + 1)) + f") / {n}"


def _with_p(folds: str) -> str:
    """folds with p: the continued fraction of the incomplete beta function, from its last term to the first."""
    hi_lo = f"SELECT *, 3.26 + ln(hi) AS a0, 1.63 + ln(lo) AS b0, hi / lo / (1 + hi / lo) AS x0 FROM (SELECT *, greatest(x, y) + 1 AS hi, least(x, y) + 1 AS lo FROM ({folds}) p1) p2"
    picked = f"SELECT *, CASE WHEN swap THEN b0 ELSE a0 END AS a, CASE WHEN swap THEN a0 ELSE b0 END AS b, CASE WHEN swap THEN 1 - x0 ELSE x0 END AS z FROM (SELECT *, x0 > (a0 + 1) / (a0 + b0 + 2) AS swap FROM ({hi_lo}) p3) p4"
    m = "floor(k / 2)"
    term = f"CASE WHEN k % 2 = 0 THEN {m} * (b - {m}) * z / ((a + 2 * {m} - 1) * (a + 2 * {m})) ELSE -(a + {m}) * (a + b + {m}) * z / ((a + 2 * {m}) * (a + 2 * {m} + 1)) END"
    fraction = f"list_reduce(list_transform(range({differential.TERMS}), lambda i: CAST({differential.TERMS} - i AS DOUBLE)), lambda after, k: ({term}) / (1 + after), CAST(0 AS DOUBLE))"
    part = f"exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(z) + b * ln(1 - z)) / a / (1 + {fraction})"
    return f"SELECT * EXCLUDE (part), CASE WHEN swap THEN part ELSE 1 - part END AS p FROM (SELECT *, {part} AS part FROM ({picked}) p5) p6"


_FOLDS_P, _ISO_FOLDS_P, _MEASURE_FOLDS_P = _with_p(_FOLDS), _with_p(_FOLDS.replace("totals", "isototals")), _with_p(_MEASURE_FOLDS)
_SIGNIFICANT = f"SELECT anno, sample, kind FROM (SELECT anno, s1 AS sample, CASE WHEN count(*) FILTER (WHERE fold >= 2 AND p <= 0.05) = (SELECT count(DISTINCT sample) - 1 FROM isototals) THEN 'UniLike' WHEN count(*) FILTER (WHERE fold <= 0.5 AND p <= 0.05) = (SELECT count(DISTINCT sample) - 1 FROM isototals) THEN 'DisLike' END AS kind FROM ({_ISO_FOLDS_P}) f GROUP BY anno, s1) x WHERE kind IS NOT NULL"

_CLASSES = ", ".join(f"round(sum(CASE WHEN tail_class = '{k}' THEN ppm ELSE 0 END), 4) AS {k.lower()}" for k in ("A", "C", "G", "U", "Other", "GM"))
_BAND = "SELECT anno FROM (SELECT anno, t, row_number() OVER (ORDER BY t, anno) AS r, count(*) OVER () AS n, min(t) OVER () AS least FROM (SELECT anno, round(sum(ppm), 6) AS t FROM iso GROUP BY anno) x) y WHERE r > n * 15 // 100 AND r <= n * 85 // 100 AND t > least"
_MARKS = f"SELECT sample, anno, seed, CASE WHEN bool_or(hit) THEN '!' ELSE '' END || CASE WHEN row_number() OVER (PARTITION BY sample, anno ORDER BY round(sum(ppm), 6) DESC, seed) = 1 THEN '*' ELSE '' END AS mark FROM (SELECT sample, anno, {_MARKED} AS seed, ppm, tag_id IN (SELECT tag_id FROM hits WHERE biotype = 'rmsk') AS hit FROM annotated) x GROUP BY sample, anno, seed"

_KEPT = "FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY ppm, anno) - 1 AS i, count(*) OVER (PARTITION BY sample) AS n, sum(ppm) OVER (PARTITION BY sample) AS whole FROM totals WHERE ppm > 0) x"
_TMM = f"SELECT *, i >= n * 30.0 / 100 AND i <= n - n * 30.0 / 100 AS kept, log2(ppm / whole) / log2(1.0 / n) AS m, (whole - ppm) / (whole * ppm) + CAST(n - 1 AS DOUBLE) / n AS w {_KEPT}"
_REGION = "SELECT *, greatest(min(t_start) OVER k - 10, 1) AS r_start, max(t_end) OVER k + 10 AS r_end FROM mirhits WINDOW k AS (PARTITION BY mir, chrom, strand, f_start)"
_PLACE = ["mir", "chrom", "strand", "f_start"]

Build = Callable[[Base], DataFrame]
#: name: (query, SQL, the common table expressions that the SQL reads)
REPORTS: dict[str, tuple[Build, str, tuple[str, ...]]] = {
    "decode_alignment": (
        lambda b: tag_ops.decode_alignment(b.alignments()).select("sample", "qname", "strand", "chrom", "gm_len", "t_end"),
        "SELECT sample, qname, CASE WHEN flag = 0 THEN '+' ELSE '-' END AS strand, 'chr' || rname AS chrom, CAST(regexp_extract(cigar, '(\\d+)M', 1) AS INT) AS gm_len, pos + CAST(regexp_extract(cigar, '(\\d+)M', 1) AS INT) AS t_end FROM alignments",
        ("alignments",),
    ),
    "classify_tail": (
        lambda b: b.tags().groupBy("sample", classify_tail(F.col("tail")).alias("tail_class")).agg(F.count("*").alias("n"), F.sum("reads").alias("reads")),
        "SELECT sample, CASE WHEN tail = '' THEN 'GM' WHEN tail IN ('A', 'C', 'G') THEN tail WHEN tail = 'TT' THEN 'U' ELSE 'Other' END AS tail_class, count(*) AS n, CAST(sum(reads) AS BIGINT) AS reads FROM tags0 GROUP BY ALL",
        ("tags0",),
    ),
    "trim_long_tail": (
        lambda b: tag_ops.trim_long_tail(b.alignments(), 1).groupBy("sample", "tl").agg(F.count("*").alias("n")),
        "SELECT sample, CASE WHEN length(tl) > 1 THEN '' ELSE tl END AS tl, count(*) AS n FROM alignments GROUP BY ALL",
        ("alignments",),
    ),
    "filter_read_quality": (
        lambda b: tag_ops.filter_read_quality(b.alignments(), 20, 23).groupBy("sample").agg(F.count("*").alias("n")),
        "SELECT sample, count(*) AS n FROM alignments WHERE length(seq) BETWEEN 20 AND 23 AND regexp_full_match(seq, '[ACGT]+') GROUP BY sample",
        ("alignments",),
    ),
    "normalize_ppm": (lambda b: b.tags().select("tag_id", "sample", "weight", "ppm"), "SELECT tag_id, sample, round(weight, 4) AS weight, round(ppm, 4) AS ppm FROM tags", ("tags",)),
    "mappability": (
        lambda b: tag_ops.mappability(b.alignments().withColumnRenamed("qname", "read_id"), b.alignments().where("nh = 1")),
        "SELECT sample, count(*) AS raw, count(*) FILTER (WHERE seq LIKE '%N%') AS with_n, count(*) FILTER (WHERE regexp_full_match(seq, '[ACGT]+') AND length(seq) BETWEEN 15 AND 30) AS filtered, count(*) FILTER (WHERE hit) AS mappable, round(count(*) FILTER (WHERE hit) * 100.0 / count(*), 4) AS pct FROM (SELECT *, bool_or(nh = 1) OVER (PARTITION BY sample, qname) AS hit FROM alignments) x GROUP BY sample",
        ("alignments",),
    ),
    "annotate_intervals": (
        lambda b: intervals.annotate_intervals(b.view(adapters.TAGS), b.features()).select("tag_id", "db_idx", "biotype", "name", "f_start", "f_end"),
        "SELECT tag_id, db_idx, biotype, name, f_start, f_end FROM hits0",
        ("hits0",),
    ),
    "assign_arm": (lambda b: b.hits().groupBy("sample", "name").agg(F.count("*").alias("n")), "SELECT sample, name, count(*) AS n FROM hits GROUP BY ALL", ("hits",)),
    "annotate_variants": (
        lambda b: intervals.annotate_variants(b.view(adapters.VARIANTS), b.features(), SLOTS),
        "SELECT v.variant_id, v.chrom, v.pos, v.ref, v.alt, " + ", ".join(f"coalesce(max({{'a': db_idx, 'b': f_start, 'c': f_end, 'd': name}}) FILTER (WHERE biotype = '{x}').d, '.') AS {s}" for s, x in SLOTS.items()) + " FROM variants v LEFT JOIN features f ON v.chrom = f.chrom AND v.pos - 1 < f.f_end AND v.pos - 1 + length(v.ref) > f.f_start GROUP BY ALL",
        ("variants", "features"),
    ),
    "exclude_overlapping": (
        lambda b: intervals.exclude_overlapping(b.features().where("biotype = 'miRNA'"), b.features().where("biotype = 'mirtron'")).select("chrom", "strand", "f_start", "f_end", "name"),
        "SELECT chrom, strand, f_start, f_end, name FROM features f WHERE biotype = 'miRNA' AND NOT EXISTS (SELECT 1 FROM features m WHERE m.biotype = 'mirtron' AND m.chrom = f.chrom AND m.strand = f.strand AND f.f_start <= m.f_end AND f.f_end >= m.f_start)",
        ("features",),
    ),
    "label_rules": (
        lambda b: counting.label_rules(b.hits(), [("rmsk", True, "exact"), ("mi", False, "prefix"), ("RNA", True, "suffix")]).groupBy("is_flagged").agg(F.count("*").alias("n")),
        "SELECT is_flagged, count(*) AS n FROM (SELECT tag_id, bool_or(CASE WHEN biotype = 'rmsk' THEN true WHEN biotype LIKE 'mi%' THEN false WHEN biotype LIKE '%RNA' THEN true ELSE false END) AS is_flagged FROM hits GROUP BY tag_id) x GROUP BY is_flagged",
        ("hits",),
    ),
    "prioritize_biotype": (
        lambda b: b.prioritized(),
        "SELECT tag_id, biotype, name FROM prime UNION ALL SELECT tag_id, 'un_annotated', chrom || ':' || CAST(t_start AS STRING) || '-' || CAST(t_end AS STRING) FROM tags t WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.tag_id = t.tag_id)",
        ("prime",),
    ),
    "biotype_statistics": (lambda b: counting.biotype_statistics(b.hits()), "SELECT coalesce(sample, 'Total') AS sample, coalesce(biotype, 'Total') AS biotype, round(sum(v), 4) AS value FROM (SELECT sample, biotype, sum(weight) / count(*) AS v FROM hits GROUP BY ALL) x GROUP BY CUBE (sample, biotype)", ("hits",)),
    "isoform_counts": (lambda b: b.iso(), "SELECT sample, biotype, anno, seed, tail_class, read_len, round(ppm, 4) AS ppm FROM iso", ("iso",)),
    "isoform_counts_floor": (
        lambda b: counting.isoform_counts(b.tags(), b.prime(), 15.0),
        "SELECT sample, biotype, anno, seed || CASE WHEN mismatch_pos BETWEEN 1 AND 7 THEN '|' || CAST(mismatch_pos - 1 AS VARCHAR) || translate(substring(seq, mismatch_pos + 1, 1), 'T', 'U') ELSE '' END AS seed, tail_class, read_len, round(sum(ppm), 4) AS ppm FROM annotated WHERE ppm >= 15 GROUP BY ALL",
        ("annotated",),
    ),
    "flag_isoform": (
        lambda b: b.flagged(),
        "SELECT sample, anno, seed || CASE WHEN mismatch_pos BETWEEN 1 AND 7 THEN '|' || CAST(mismatch_pos - 1 AS VARCHAR) || translate(substring(seq, mismatch_pos + 1, 1), 'T', 'U') ELSE '' END AS seed, bool_or(tag_id IN (SELECT tag_id FROM hits WHERE biotype = 'rmsk')) AS is_flagged FROM annotated GROUP BY ALL",
        ("annotated", "hits"),
    ),
    "densify": (
        lambda b: counting.densify(b.counts(), ["sample", "biotype", "tail_class", "read_len"]),
        "SELECT a.sample, b.biotype, c.tail_class, d.read_len, round(coalesce(ppm, 1e-6), 4) AS ppm FROM (SELECT DISTINCT sample FROM counts) a CROSS JOIN (SELECT DISTINCT biotype FROM counts) b CROSS JOIN (SELECT DISTINCT tail_class FROM counts) c CROSS JOIN (SELECT DISTINCT read_len FROM counts) d LEFT JOIN counts x USING (sample, biotype, tail_class, read_len)",
        ("counts",),
    ),
    "biotype_counts": (lambda b: b.counts(), "SELECT sample, biotype, tail_class, read_len, round(ppm, 4) AS ppm FROM counts", ("counts",)),
    "dominant_isoform": (
        lambda b: counting.dominant_isoform(b.iso()),
        "SELECT sample, anno, seed FROM (SELECT sample, anno, seed, row_number() OVER (PARTITION BY sample, anno ORDER BY round(sum(ppm), 6) DESC, seed) AS r FROM iso GROUP BY sample, anno, seed) x WHERE r = 1",
        ("iso",),
    ),
    "annotation_index": (lambda b: counting.annotation_index(b.iso(), 1000.0), "SELECT DISTINCT anno, seed FROM iso WHERE anno IN (SELECT anno FROM iso GROUP BY anno HAVING sum(ppm) >= 1000)", ("iso",)),
    "length_index": (lambda b: counting.length_index(b.tags(), FLOOR), f"SELECT CAST(unnest(range(min(gm_len), max(gm_len) + 1)) AS INT) AS read_len FROM tags WHERE ppm >= {FLOOR}", ("tags",)),
    "token_table": (lambda b: counting.token_table(b.iso(), "anno"), f"SELECT sample, anno, {_MEASURES} FROM iso GROUP BY sample, anno", ("iso",)),
    "token_table_isoform": (lambda b: counting.token_table(b.iso(), "anno", "seed"), f"SELECT sample, anno, seed, {_MEASURES} FROM iso GROUP BY sample, anno, seed", ("iso",)),
    "biotype_length_table": (lambda b: counting.biotype_length_table(b.counts()), f"SELECT sample, biotype, read_len, {_MEASURES} FROM counts GROUP BY sample, biotype, read_len", ("counts",)),
    "biotype_composition": (
        lambda b: counting.biotype_composition(b.counts()),
        "SELECT sample, biotype, round(sum(ppm) * 100 / sum(sum(ppm)) OVER (PARTITION BY sample), 4) AS pct FROM counts GROUP BY sample, biotype",
        ("counts",),
    ),
    "tail_breakdown": (lambda b: counting.tail_breakdown(b.iso(), "anno"), f"SELECT sample, anno, {_MEASURES}, {_TAILS} FROM iso GROUP BY sample, anno", ("iso",)),
    "length_distribution": (
        lambda b: counting.length_distribution(b.iso()),
        "SELECT sample, read_len, coalesce(anno, 'All') AS anno, " + ", ".join(f"round(sum(CASE WHEN tail_class = '{k}' THEN ppm ELSE 0 END), 4) AS {k.lower()}" for k in ("A", "C", "G", "U", "Other", "GM")) + " FROM iso GROUP BY GROUPING SETS ((sample, read_len, anno), (sample, read_len))",
        ("iso",),
    ),
    "length_distribution_isoform": (
        lambda b: counting.length_distribution(b.iso(), "seed", trimmed=profiles.trim_rank_band(b.iso())),
        f"SELECT sample, read_len, anno, seed, {_CLASSES} FROM iso GROUP BY sample, read_len, anno, seed UNION ALL SELECT sample, read_len, 'All', '', {_CLASSES} FROM iso GROUP BY sample, read_len UNION ALL SELECT sample, read_len, 'Alltrim', '', {_CLASSES} FROM iso WHERE anno IN ({_BAND}) GROUP BY sample, read_len",
        ("iso",),
    ),
    "isoform_marks": (lambda b: b.marks(), f"SELECT sample, anno, seed, mark FROM ({_MARKS}) m WHERE mark <> ''", ("annotated", "hits", "iso")),
    "token_table_marked": (
        lambda b: counting.labelled(counting.token_table(b.iso(), "anno", "seed"), b.marks(), wide=True),
        f"SELECT sample, t.anno, t.seed, t.anno || '_' || t.seed || coalesce(mark, '') AS label, gm, pm, gmpm, tailing FROM (SELECT sample, anno, seed, {_MEASURES} FROM iso GROUP BY sample, anno, seed) t LEFT JOIN (SELECT anno, seed, mark FROM ({_MARKS}) m WHERE sample = (SELECT min(sample) FROM iso)) m ON m.anno = t.anno AND m.seed = t.seed",
        ("annotated", "hits", "iso"),
    ),
    "tail_breakdown_isoform": (
        lambda b: counting.labelled(counting.tail_breakdown(b.iso(), "anno", "seed"), b.marks()).drop("anno", "seed"),
        f"SELECT t.* EXCLUDE (anno, seed), t.anno || '_' || t.seed || coalesce(mark, '') AS label FROM (SELECT sample, anno, seed, {_MEASURES}, {_TAILS} FROM iso GROUP BY sample, anno, seed) t LEFT JOIN ({_MARKS}) m ON m.sample = t.sample AND m.anno = t.anno AND m.seed = t.seed",
        ("annotated", "hits", "iso"),
    ),
    "length_tables": (
        lambda b: counting.length_tables(b.iso()),
        "SELECT anno, read_len, sample, round(sum(CASE WHEN tail_class = 'GM' THEN ppm ELSE 0 END), 4) AS gm, round(sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END), 4) AS pm, round(sum(ppm), 4) AS gmpm, round(sum(sum(ppm)) OVER (PARTITION BY anno, read_len), 4) AS total FROM iso GROUP BY anno, read_len, sample",
        ("iso",),
    ),
    "seed_matrix": (lambda b: counting.seed_matrix(b.iso()), "SELECT sample, seed, anno, round(sum(ppm), 4) AS ppm FROM iso GROUP BY ALL", ("iso",)),
    "arm_share": (
        lambda b: counting.arm_share(b.iso(), paired=True),
        f"SELECT sample, mir, round(v5 / (v5 + v3), 4) AS p5, round(v3 / (v5 + v3), 4) AS p3 FROM (SELECT sample, {_PRE} AS mir, sum(CASE WHEN {_ARM} = '5p' THEN ppm ELSE 0 END) AS v5, sum(CASE WHEN {_ARM} = '3p' THEN ppm ELSE 0 END) AS v3 FROM iso WHERE {_ARM} <> '' GROUP BY ALL) x WHERE v5 > 0 AND v3 > 0",
        ("iso",),
    ),
    "trim_rank_band": (
        lambda b: profiles.trim_rank_band(b.iso()).select("anno").distinct(),
        "SELECT anno FROM (SELECT anno, t, row_number() OVER (ORDER BY t, anno) AS r, count(*) OVER () AS n, min(t) OVER () AS least FROM (SELECT anno, round(sum(ppm), 6) AS t FROM iso GROUP BY anno) x) y WHERE r > n * 15 // 100 AND r <= n * 85 // 100 AND t > least",
        ("iso",),
    ),
    "quantile_normalize": (
        lambda b: profiles.quantile_normalize(b.iso()).groupBy("sample", "anno").agg(F.sum("ppm").alias("ppm")),
        "SELECT sample, anno, round(avg(m) OVER (PARTITION BY sample, ppm), 4) AS ppm FROM (SELECT sample, anno, ppm, avg(ppm) OVER (PARTITION BY r) AS m FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY ppm, anno) AS r FROM totals) x) y",
        ("totals",),
    ),
    "normalized_expression": (
        lambda b: profiles.normalized_expression(b.iso()),
        "SELECT sample, anno, seed, round(sum(ppm), 4) AS ppm FROM iso GROUP BY GROUPING SETS ((sample, anno), (sample, anno, seed))",
        ("iso",),
    ),
    "rank_report": (
        lambda b: profiles.rank_report(b.totals()),
        "SELECT sample, anno, round(ppm, 4) AS ppm, CAST(row_number() OVER (PARTITION BY sample ORDER BY ppm, anno) AS INT) AS rank FROM totals",
        ("totals",),
    ),
    "rank_sum_order": (
        lambda b: profiles.rank_sum(profiles.rank_report(b.totals())),
        "SELECT anno, CAST(sum(r) AS BIGINT) AS rank_sum FROM (SELECT anno, row_number() OVER (PARTITION BY sample ORDER BY ppm, anno) AS r FROM totals) x GROUP BY anno",
        ("totals",),
    ),
    "pairwise_fold": (lambda b: profiles.pairwise_fold(b.totals()), f"SELECT anno, s1, s2, round(x, 4) AS x, round(y, 4) AS y, round(fold, 4) AS fold, round(x + y, 4) AS total FROM ({_FOLDS}) f", ("totals",)),
    "preference_sets": (
        lambda b: profiles.preference_sets(profiles.pairwise_fold(b.totals()), 1.2, None),
        _PREFERENCES,
        ("totals",),
    ),
    "loading_difference": (
        lambda b: profiles.loading_difference(b.totals()),
        f"SELECT anno, round(total, 4) AS total, round(diff, 4) AS diff, max_sample, min_sample FROM ({_LOADING.format(rows='totals')}) d",
        ("totals",),
    ),
    "length_difference": (
        lambda b: profiles.length_difference(b.iso()),
        "SELECT anno, max(len) - min(len) AS diff, max(len) AS len_max, min(len) AS len_min FROM (SELECT anno, sample, read_len AS len, row_number() OVER (PARTITION BY anno, sample ORDER BY round(sum(ppm), 6) DESC, read_len) AS r FROM iso GROUP BY anno, sample, read_len) x WHERE r = 1 GROUP BY anno",
        ("iso",),
    ),
    "arm_difference": (
        lambda b: profiles.arm_difference(b.iso()),
        f"SELECT mir, round(sum(t), 4) AS total, CASE WHEN count(DISTINCT arm) > 1 THEN 'Y' ELSE 'N' END AS is_diff FROM (SELECT mir, sample, arm, sum(p) OVER (PARTITION BY mir, sample) AS t, row_number() OVER (PARTITION BY mir, sample ORDER BY p DESC, arm) AS r FROM (SELECT {_PRE} AS mir, sample, {_ARM} AS arm, round(sum(ppm), 6) AS p FROM iso WHERE {_ARM} <> '' GROUP BY ALL) y) x WHERE r = 1 GROUP BY mir",
        ("iso",),
    ),
    "boxplot_stats": (
        lambda b: profiles.boxplot_stats(b.totals()),
        "SELECT sample, round(min(ppm), 4) AS lo, " + ", ".join(f"round(max(CASE WHEN r = CAST(floor((n - 1) * {q}) AS BIGINT) + 1 THEN ppm END), 4) AS q{i}" for i, q in ((1, 0.25), (2, 0.5), (3, 0.75))) + ", round(max(ppm), 4) AS hi FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY ppm, anno) AS r, count(*) OVER (PARTITION BY sample) AS n FROM totals WHERE ppm > 0) x GROUP BY sample",
        ("totals",),
    ),
    "boxplot_stats_trimmed": (
        lambda b: profiles.boxplot_stats(b.totals(), 0.1),
        "SELECT sample, " + ", ".join(f"round(max(CASE WHEN r = CAST(floor((n - 1) * CAST({q} AS DOUBLE)) AS BIGINT) + 1 THEN ppm END), 4) AS {c}" for c, q in (("lo", 0.1), ("q1", 0.25), ("q2", 0.5), ("q3", 0.75), ("hi", 0.9))) + " FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY ppm, anno) AS r, count(*) OVER (PARTITION BY sample) AS n FROM totals WHERE ppm > 0) x GROUP BY sample",
        ("totals",),
    ),
    "trim_rank_band_isoform": (
        lambda b: profiles.trim_rank_band(b.iso(), keys=("anno", "seed")).select("anno", "seed").distinct(),
        "SELECT anno, seed FROM (SELECT anno, seed, t, row_number() OVER (ORDER BY t, anno, seed) AS r, count(*) OVER () AS n, min(t) OVER () AS least FROM (SELECT anno, seed, round(sum(ppm), 6) AS t FROM iso GROUP BY anno, seed) x) y WHERE r > n * 15 // 100 AND r <= n * 85 // 100 AND t > least",
        ("iso",),
    ),
    "rank_sum_tokens": (lambda b: profiles.rank_sum_tokens(counting.token_table(b.iso(), "anno"), "anno"), _RANKS.format(keys="anno", back="anno DESC"), ("iso",)),
    "rank_sum_tokens_isoform": (lambda b: profiles.rank_sum_tokens(counting.token_table(b.iso(), "anno", "seed"), "anno", "seed"), _RANKS.format(keys="anno, seed", back="anno DESC, seed DESC"), ("iso",)),
    "dataset_overlap_info": (
        lambda b: profiles.dataset_overlap(counting.dominant_isoform(b.iso()).select("anno", F.col("seed").alias("info"), F.col("sample").alias("dataset")), "info"),
        "SELECT anno, seed AS info, string_agg(sample, ',' ORDER BY sample) AS datasets, count(*) AS n FROM (SELECT sample, anno, seed, row_number() OVER (PARTITION BY sample, anno ORDER BY round(sum(ppm), 6) DESC, seed) AS r FROM iso GROUP BY sample, anno, seed) x WHERE r = 1 GROUP BY anno, seed HAVING count(*) > 1",
        ("iso",),
    ),
    "two_sample_table_log": (
        lambda b: views.two_sample_table(b.totals(), "AF", "RF", 50.0, 2.0),
        f"SELECT anno, CASE WHEN x > 0 THEN round(log2(x), 2) ELSE 0 END AS x, CASE WHEN y > 0 THEN round(log2(y), 2) ELSE 0 END AS y FROM ({_XY}) t WHERE x >= 50 OR y >= 50",
        ("totals",),
    ),
    "difference_histogram_bounded": (
        lambda b: views.difference_histogram(views.two_sample_table(b.totals(), "AF", "RF"), 5, 20.0, 5000.0),
        f"SELECT CAST(least(CASE WHEN hi > lo THEN floor((d - lo) * 5 / (hi - lo)) ELSE 0 END, 4) AS INT) AS bin, side, count(*) AS n FROM (SELECT *, min(d) OVER () AS lo, max(d) OVER () AS hi FROM (SELECT abs(x - y) AS d, CAST(sign(x - y) AS INT) AS side FROM ({_XY}) t) u WHERE d BETWEEN 20 AND 5000) v GROUP BY ALL",
        ("totals",),
    ),
    "seed_length_matrix_log": (
        lambda b: views.seed_length_matrix(b.iso(), log2=True),
        "SELECT mir, arm, seed, read_len, " + ", ".join(f"round(CASE WHEN {c} > 0 THEN log2({c}) ELSE 0 END, 4) AS {c}" for c in ("gm", "pm", "gmpm", "a_tail", "c_tail", "g_tail", "u_tail", "other_tail")) + f" FROM (SELECT mir, arm, seed, read_len, sum(CASE WHEN tail_class = 'GM' THEN ppm ELSE 0 END) AS gm, sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END) AS pm, sum(ppm) AS gmpm, {_TAILS.replace('round(', '').replace(', 4)', '')} FROM (SELECT *, {_PRE} AS mir, {_ARM} AS arm FROM iso) x WHERE arm <> '' GROUP BY GROUPING SETS ((mir, arm, seed, read_len), (mir, arm, seed), (mir, arm, read_len))) y",
        ("iso",),
    ),
    "length_by_tail": (
        lambda b: views.length_by_tail(b.iso(), "mir-1-3p", 10.0),
        "SELECT sample, read_len, " + ", ".join(f"round(sum(CASE WHEN tail_class = '{k}' THEN ppm ELSE 0 END) / 10, 4) AS {k.lower()}" for k in ("A", "C", "G", "U", "Other", "GM")) + " FROM iso WHERE anno = 'mir-1-3p' GROUP BY sample, read_len",
        ("iso",),
    ),
    "ranked_bins_highest": (
        lambda b: views.ranked_bin_composition(b.iso(), 5, "tailing", "highest", 20, ratio=False),
        "SELECT sample, CAST((r - 1) // 5 AS INT) AS bin, " + ", ".join(f"round(sum(t_{k}) / sum(t), 4) AS {k}" for k in ("a", "c", "g", "u", "other", "gm")) + f" FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY q) AS r FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY v, anno) AS q, count(*) OVER (PARTITION BY sample) AS n FROM (SELECT *, CASE WHEN t_gm + t_pm < 1 THEN 0 ELSE round(t_pm * 100 / (t_gm + t_pm), 6) END AS v FROM (SELECT sample, anno, round(sum(ppm), 6) AS t, sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END) AS t_pm, {_SHARES} FROM iso GROUP BY sample, anno) x WHERE t > 0) y) z WHERE q > n - 20) w GROUP BY ALL",
        ("iso",),
    ),
    "ranked_bins_trimmed": (
        lambda b: views.ranked_bin_composition(b.iso(), 10, trim=10),
        f"SELECT sample, CAST((r - 1) // 10 AS INT) AS bin, {_AVERAGES} FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY q) AS r FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY t, anno) AS q, count(*) OVER (PARTITION BY sample) AS n FROM (SELECT sample, anno, round(sum(ppm), 6) AS t, {_SHARES} FROM iso GROUP BY sample, anno) x WHERE t > 0) y WHERE q > n * 10 // 100 AND q <= n - n * 10 // 100) z GROUP BY ALL",
        ("iso",),
    ),
    "filter_value_matrix_log": (
        lambda b: views.filter_value_matrix(b.totals(), 8.0, 11.0, 2.0, "5p", counting.dominant_isoform(b.iso()).where("seed LIKE '%A'")),
        f"SELECT anno, round(sum(p), 4) AS total FROM (SELECT sample, anno, CASE WHEN ppm > 0 THEN log2(ppm) ELSE 0 END AS p FROM totals WHERE {_ARM} = '5p' AND anno IN (SELECT anno FROM (SELECT anno, seed, row_number() OVER (PARTITION BY sample, anno ORDER BY round(sum(ppm), 6) DESC, seed) AS r FROM iso GROUP BY sample, anno, seed) d WHERE r = 1 AND seed LIKE '%A')) x GROUP BY anno HAVING max(p) > 8 AND (min(p) < 11 OR count(*) < (SELECT count(DISTINCT sample) FROM totals WHERE {_ARM} = '5p'))",
        ("totals", "iso"),
    ),
    "loading_trend": (lambda b: profiles.loading_trend(b.totals()), "SELECT sample, anno, round(ppm / sum(ppm) OVER (PARTITION BY anno), 4) AS share FROM totals", ("totals",)),
    "end_heterogeneity": (
        lambda b: profiles.end_heterogeneity(b.annotated()),
        f"SELECT sample, anno, round(f.h, 4) AS h5, round(t.h, 4) AS h3, round(g.h, 4) AS h_tail FROM ({_ENDS.format(end=_FIVE)}) f JOIN ({_ENDS.format(end=_THREE)}) t USING (sample, anno) JOIN ({_ENDS.format(end=_TAIL_END)}) g USING (sample, anno)",
        ("annotated",),
    ),
    "tail_profile": (
        lambda b: profiles.tail_profile(b.annotated()),
        f"SELECT sample, anno, {_TAIL_PROFILE} GROUP BY sample, anno",
        ("annotated",),
    ),
    "tail_profile_isoform": (
        lambda b: profiles.tail_profile(b.seeded(), "seed"),
        f"SELECT sample, anno, {_MARKED} AS seed, {_TAIL_PROFILE} GROUP BY sample, anno, {_MARKED}",
        ("annotated",),
    ),
    "tail_bases": (
        lambda b: profiles.tail_bases(b.seeded()),
        f"SELECT sample, anno, {_MARKED} AS seed, round(sum(ppm), 4) AS gmpm, round(sum(CASE WHEN tail = '' THEN ppm ELSE 0 END), 4) AS gm, round(sum(CASE WHEN tail <> '' THEN ppm ELSE 0 END), 4) AS pm, " + ", ".join(f"round(sum(CASE WHEN tail <> '' THEN ppm * len(list_filter(string_split(translate(tail, 'T', 'U'), ''), lambda x: x = '{b}')) / length(tail) ELSE 0 END), 4) AS {b.lower()}" for b in "ACGU") + f" FROM annotated GROUP BY sample, anno, {_MARKED}",
        ("annotated",),
    ),
    "mismatch_positions": (lambda b: profiles.mismatch_positions(b.tags()), "SELECT sample, mismatch_pos AS pos, round(sum(ppm), 4) AS ppm FROM tags WHERE mismatch_pos IS NOT NULL GROUP BY ALL", ("tags",)),
    "positional_composition": (
        lambda b: profiles.positional_composition(b.tags()),
        "SELECT sample, CAST(slot AS INT) AS slot, translate(substring(seq, CAST(slot AS INT) + 1, 1), 'T', 'U') AS nt, round(sum(ppm), 4) AS ppm FROM tags, range(8) s(slot) GROUP BY ALL",
        ("tags",),
    ),
    "merge_supported_ranges": (
        lambda b: profiles.merged_ranges(b.annotated()),
        "SELECT anno, chrom, strand, min(t_start) AS m_start, max(t_end) AS m_end, count(*) AS support FROM (SELECT *, sum(new) OVER (PARTITION BY anno, chrom, strand ORDER BY t_start, t_end) AS island FROM (SELECT *, CASE WHEN t_start - 2 > coalesce(max(t_end) OVER (PARTITION BY anno, chrom, strand ORDER BY t_start, t_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1000000000000) + 2 THEN 1 ELSE 0 END AS new FROM (SELECT DISTINCT anno, chrom, strand, t_start, t_end FROM annotated) x) y) z GROUP BY anno, chrom, strand, island",
        ("annotated",),
    ),
    "feature_type_counts": (lambda b: b.features().groupBy("biotype").agg(F.count("*").alias("n")), "SELECT biotype, count(*) AS n FROM features GROUP BY biotype", ("features",)),
    "dataset_overlap_detail": (
        lambda b: profiles.dataset_overlap(b.totals().where("ppm > 500").withColumn("dataset", F.col("sample"))),
        "SELECT anno, string_agg(DISTINCT sample, ',' ORDER BY sample) AS datasets, count(DISTINCT sample) AS n FROM totals WHERE ppm > 500 GROUP BY anno HAVING count(DISTINCT sample) > 1",
        ("totals",),
    ),
    "dataset_overlap_report": (
        lambda b: profiles.dataset_combinations(b.totals().where("ppm > 500").withColumn("dataset", F.col("sample"))),
        "SELECT datasets, count(*) AS n FROM (SELECT anno, string_agg(DISTINCT sample, ',' ORDER BY sample) AS datasets FROM totals WHERE ppm > 500 GROUP BY anno) x GROUP BY datasets",
        ("totals",),
    ),
    "two_sample_table": (lambda b: views.two_sample_table(b.totals(), "AF", "RF"), f"SELECT anno, round(x, 4) AS x, round(y, 4) AS y FROM ({_XY}) t", ("totals",)),
    "difference_histogram": (
        lambda b: views.difference_histogram(views.two_sample_table(b.totals(), "AF", "RF")),
        f"SELECT CAST(least(CASE WHEN hi > lo THEN floor((d - lo) * 10 / (hi - lo)) ELSE 0 END, 9) AS INT) AS bin, side, count(*) AS n FROM (SELECT *, min(d) OVER () AS lo, max(d) OVER () AS hi FROM (SELECT abs(x - y) AS d, CAST(sign(x - y) AS INT) AS side FROM ({_XY}) t) u WHERE d > 0) v GROUP BY ALL",
        ("totals",),
    ),
    "merge_regions": (
        lambda b: views.merge_regions(b.tags().join(b.hits().select("tag_id"), "tag_id", "left_anti")),
        f"SELECT sample, chrom, min(t_start) AS m_start, max(t_end) AS m_end, round(sum(ppm), 4) AS ppm FROM ({_ISLANDS.format(by='sample, chrom', rows='(SELECT * FROM tags t WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.tag_id = t.tag_id)) z')}) i GROUP BY sample, chrom, island",
        ("hits",),
    ),
    "pileup_segments": (
        lambda b: views.pileup_segments(b.annotated()),
        f"SELECT anno, chrom, strand, s_start, s_end, round(ppm, 4) AS ppm FROM (SELECT *, row_number() OVER (PARTITION BY anno ORDER BY ppm DESC, chrom, strand, s_start, s_end) AS r FROM (SELECT anno, chrom, strand, min(t_start) AS s_start, max(t_end) AS s_end, round(sum(ppm), 6) AS ppm FROM ({_ISLANDS.format(by='anno, chrom, strand', rows='annotated')}) i GROUP BY anno, chrom, strand, island) g) k WHERE r = 1",
        ("annotated",),
    ),
    "pileup_seeds": (
        lambda b: views.pileup_seeds(b.tails()),
        "SELECT anno, chrom, strand, t_start - first AS distance, round(sum(CASE WHEN tail_class = 'GM' THEN ppm ELSE 0 END), 4) AS gm, round(sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END), 4) AS pm, count(*) AS n, max(read_len) AS longest FROM (SELECT *, min(t_start) OVER (PARTITION BY anno, chrom, strand) AS first FROM annotated) x GROUP BY anno, chrom, strand, t_start - first",
        ("annotated",),
    ),
    "seed_length_matrix": (
        lambda b: views.seed_length_matrix(b.iso()),
        f"SELECT mir, arm, seed, read_len, round(sum(CASE WHEN tail_class = 'GM' THEN ppm ELSE 0 END), 4) AS gm, round(sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END), 4) AS pm, round(sum(ppm), 4) AS gmpm, {_TAILS} FROM (SELECT *, {_PRE} AS mir, {_ARM} AS arm FROM iso) x WHERE arm <> '' GROUP BY GROUPING SETS ((mir, arm, seed, read_len), (mir, arm, seed), (mir, arm, read_len))",
        ("iso",),
    ),
    "seed_heatmap": (
        lambda b: views.seed_heatmap(b.iso()),
        "SELECT seed, bin, round(sum(p) / max(members), 4) AS value, (min({'v': -p, 'a': anno})).a AS top FROM (SELECT seed, anno, round(sum(ppm), 6) AS p FROM iso GROUP BY ALL) c JOIN (SELECT anno, bin, count(*) OVER (PARTITION BY bin) AS members FROM (SELECT anno, CAST((row_number() OVER (ORDER BY anno) - 1) // 5 AS INT) AS bin FROM (SELECT DISTINCT anno FROM iso) d) e) n USING (anno) GROUP BY seed, bin",
        ("iso",),
    ),
    "seed_slices": (lambda b: views.seed_slices(b.iso(), 50.0), "SELECT sample, seed, anno, round(sum(ppm), 4) AS ppm FROM iso GROUP BY sample, seed, anno HAVING sum(ppm) >= 50", ("iso",)),
    "length_view": (
        lambda b: views.scale_to_max(b.iso().groupBy("sample", "anno").agg(F.sum("ppm").alias("ppm")), "ppm", "sample"),
        "SELECT sample, anno, round(sum(ppm), 4) AS ppm, round(sum(ppm) * 100 / max(sum(ppm)) OVER (PARTITION BY sample), 4) AS scaled FROM iso GROUP BY sample, anno",
        ("iso",),
    ),
    "tail_scatter": (
        lambda b: views.tail_scatter(b.iso(), "A", 10.0, "5p"),
        f"SELECT sample, anno, round(log2(sum(ppm)), 4) AS x, round(sum(CASE WHEN tail_class = 'A' THEN ppm ELSE 0 END) / sum(ppm), 4) AS y FROM iso WHERE {_ARM} = '5p' GROUP BY sample, anno HAVING sum(ppm) >= 10",
        ("iso",),
    ),
    "rank_annotations": (
        lambda b: views.rank_annotations(b.totals(), merge_arms=True),
        f"SELECT sample, anno, round(ppm, 4) AS ppm, CAST(row_number() OVER (PARTITION BY sample ORDER BY ppm DESC, anno DESC) AS INT) AS rank FROM (SELECT sample, {_PRE} AS anno, round(sum(ppm), 6) AS ppm FROM totals GROUP BY ALL) x",
        ("totals",),
    ),
    "stacked_cumulative": (
        lambda b: views.stacked_cumulative(profiles.positional_composition(b.tags())),
        "SELECT sample, slot, nt, round(share, 4) AS share, round(sum(share) OVER (PARTITION BY sample, slot ORDER BY nt), 4) AS top FROM (SELECT sample, slot, nt, sum(ppm) / sum(sum(ppm)) OVER (PARTITION BY sample, slot) AS share FROM (SELECT sample, ppm, CAST(slot AS INT) AS slot, translate(substring(seq, CAST(slot AS INT) + 1, 1), 'T', 'U') AS nt FROM tags, range(8) s(slot)) x GROUP BY sample, slot, nt) y",
        ("tags",),
    ),
    "ranked_bin_composition": (
        lambda b: views.ranked_bin_composition(b.iso()),
        f"SELECT sample, CAST((r - 1) // 10 AS INT) AS bin, {_AVERAGES} FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY t, anno) AS r FROM (SELECT sample, anno, round(sum(ppm), 6) AS t, {_SHARES} FROM iso GROUP BY sample, anno) x WHERE t > 0) y GROUP BY ALL",
        ("iso",),
    ),
    "token_view_seed": (lambda b: views.token_view(b.iso(), "Seed"), "SELECT sample, seed, tail_class, read_len, round(sum(ppm), 4) AS ppm FROM iso GROUP BY sample, seed, tail_class, read_len", ("iso",)),
    "token_view_arm": (lambda b: views.token_view(b.iso(), "5p"), f"SELECT sample, biotype, anno, seed, tail_class, read_len, round(ppm, 4) AS ppm FROM iso WHERE {_ARM} = '5p'", ("iso",)),
    "filter_value_matrix": (
        lambda b: views.filter_value_matrix(b.totals(), 100.0, 3000.0),
        "SELECT anno, round(sum(ppm), 4) AS total FROM totals GROUP BY anno HAVING max(ppm) > 100 AND (min(ppm) < 3000 OR count(*) < (SELECT count(DISTINCT sample) FROM totals))",
        ("totals",),
    ),
    "length_tables_merged": (
        lambda b: views.length_tables_merged(b.iso()),
        f"SELECT {_PRE} AS mir, {_ARM} AS arm, sample, round(sum(CASE WHEN tail_class = 'GM' THEN ppm ELSE 0 END), 4) AS gm, round(sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END), 4) AS pm, round(sum(ppm), 4) AS gmpm FROM iso WHERE {_ARM} <> '' GROUP BY ALL",
        ("iso",),
    ),
    "map_names": (
        lambda b: views.map_names(b.hits(), "miRNA", "mirtron"),
        "SELECT DISTINCT a.name AS source, b.name AS target FROM hits a JOIN hits b ON a.tag_id = b.tag_id WHERE a.biotype = 'miRNA' AND b.biotype = 'mirtron'",
        ("hits",),
    ),
    "preference_semi_join": (
        lambda b: b.totals().join(profiles.preference_sets(profiles.pairwise_fold(b.totals()), 1.2, None).select("anno"), "anno", "left_semi"),
        f"SELECT sample, anno, round(ppm, 4) AS ppm FROM totals WHERE anno IN (SELECT anno FROM ({_FOLDS}) f GROUP BY anno, s1 HAVING count(*) FILTER (WHERE fold >= 1.2) = (SELECT count(DISTINCT sample) - 1 FROM totals) OR count(*) FILTER (WHERE fold <= 1 / 1.2) = (SELECT count(DISTINCT sample) - 1 FROM totals))",
        ("totals",),
    ),
    "read_sequence": (
        lambda b: sequences.extract_sequence(b.tags().withColumn("at", F.col("t_start") - 1), b.genome(), "at", "gm_len", adapters.CHUNK, "tail").select("tag_id", "sequence"),
        f"SELECT tag_id, {_SEQUENCE.format(s=f'substring(chunk, CAST((t_start - 1) % {adapters.CHUNK} + 1 AS INT), gm_len)')} || tail AS sequence FROM tags0 t JOIN genome g ON g.chrom = t.chrom AND g.chunk_id = (t_start - 1) // {adapters.CHUNK}",
        ("tags0", "genome"),
    ),
    "precursor_sequences": (
        lambda b: sequences.extract_sequence(b.features().where(F.col("biotype").isin("miRNA", "mirtron")).withColumn("bases", F.col("f_end") - F.col("f_start")), b.genome(), "f_start", "bases", adapters.CHUNK).select("name", "f_start", "f_end", "sequence"),
        f"SELECT name, f_start, f_end, {_SEQUENCE.format(s=f'substring(chunk, CAST(f_start % {adapters.CHUNK} + 1 AS INT), CAST(f_end - f_start AS INT))')} AS sequence FROM features f JOIN genome g ON g.chrom = f.chrom AND g.chunk_id = f_start // {adapters.CHUNK} WHERE biotype IN ('miRNA', 'mirtron')",
        ("features", "genome"),
    ),
    "seed_map_reads": (
        lambda b: sequences.seed_map_reads(b.genome_reads(), b.genome(), adapters.CHUNK),
        f"SELECT seq, chrom, strand, start, matched, substring(seq, matched + 1) AS tail, nh FROM (SELECT *, count(*) OVER (PARTITION BY seq) AS nh FROM (SELECT *, max(matched) OVER (PARTITION BY seq) AS most FROM (SELECT DISTINCT seq, chrom, strand, matched, CASE WHEN strand = '+' THEN ofs ELSE ofs + width - matched END AS start FROM (SELECT r.seq, s.chrom, s.strand, s.ofs, length(s.template) AS width, CAST(list_max(list_filter(range(12, least(length(r.seq), length(s.template)) + 1), lambda k: left(r.seq, CAST(k AS INT)) = left(s.template, CAST(k AS INT)))) AS INT) AS matched FROM (SELECT DISTINCT seq FROM genomereads WHERE length(seq) >= 12) r JOIN sites s ON left(r.seq, 12) = s.kmer) a) b) c WHERE matched = most) d WHERE nh <= 10",
        ("genomereads", "sites"),
    ),
    "join_targets": (lambda b: b.predictions(), "SELECT anno, seed, gene, round(pct, 4) AS pct FROM predictions", ("predictions",)),
    "preference_targets": (
        lambda b: targets.preference_targets(profiles.preference_sets(profiles.pairwise_fold(b.iso_totals()), 1.2, None), b.predictions()),
        f"SELECT DISTINCT sample, kind, gene, round(pct, 4) AS pct FROM ({_PREFERENCES.replace('totals', 'isototals')}) p JOIN predictions t ON split_part(p.anno, '|', 1) = t.anno || '_' || translate(t.seed, 'T', 'U')",
        ("isototals", "predictions"),
    ),
    "join_fold": (
        lambda b: folding.join_fold(b.precursor_reads(), b.folded()).select("tag_id", "anno", "pre_start", "pre_end", "offset"),
        "SELECT tag_id, anno, pre_start, pre_end, place AS offset FROM folded",
        ("folded",),
    ),
    "fold_entropy": (
        lambda b: folding.fold_entropy(b.precursor_reads(), b.folded()),
        f"SELECT sample, anno, round(avg(w5), 4) AS e5, round(avg(wm), 4) AS mid, round(avg(w3), 4) AS e3, round(avg(CASE WHEN tail <> '' THEN w3 END), 4) AS tail3 FROM (SELECT *, {_under('place', 8)} AS w5, {_under('place + 8', 4)} AS wm, {_under('place + 1 + gm_len - 8', 8)} AS w3 FROM folded) x GROUP BY sample, anno",
        ("folded",),
    ),
    "tmm_normalize": (
        lambda b: profiles.tmm_normalize(b.totals()),
        f"SELECT sample, anno, round(ppm * 1e6 / (whole * tmm), 4) AS ppm, round(tmm, 4) AS tmm FROM (SELECT *, sqrt(sum(w * m) FILTER (WHERE kept) OVER (PARTITION BY sample) / sum(w) FILTER (WHERE kept) OVER (PARTITION BY sample)) AS tmm FROM ({_TMM}) y) z",
        ("totals",),
    ),
    "merge_regions_bounded": (
        lambda b: regions.merge_regions(b.tags().join(b.hits().select("tag_id"), "tag_id", "left_anti"), MERGE),
        f"SELECT * FROM ({_WALK}) r",
        ("hits",),
    ),
    "region_pileup": (
        lambda b: regions.region_pileup(b.mir_hits(), _PLACE),
        f"SELECT mir, chrom, strand, f_start, r_start, r_end, tag_id, sample, CASE WHEN strand = '-' THEN r_end - t_end ELSE t_start - r_start END AS offset, gm_len AS read_len, round(ppm, 4) AS ppm, is_flagged, right(name, 2) AS arm, translate(substring(seq, 2, 7), 'T', 'U') AS seed, CASE WHEN tail = '' THEN '.' ELSE translate(tail, 'T', 'U') END AS tail, mismatch_pos FROM ({_REGION}) x",
        ("mirhits",),
    ),
    "region_sequences": (
        lambda b: sequences.extract_sequence(
            regions.region_extents(b.mir_hits(), _PLACE).withColumns({"at": F.col("r_start") - 1, "bases": F.col("r_end") - F.col("r_start")}), b.genome(), "at", "bases", adapters.CHUNK
        ).select(*_PLACE, "r_start", "r_end", "sequence"),
        f"SELECT mir, r.chrom, strand, f_start, r_start, r_end, {_SEQUENCE.format(s=f'substring(chunk, CAST((r_start - 1) % {adapters.CHUNK} + 1 AS INT), CAST(r_end - r_start AS INT))')} AS sequence FROM (SELECT DISTINCT mir, chrom, strand, f_start, r_start, r_end FROM ({_REGION}) x) r JOIN genome g ON g.chrom = r.chrom AND g.chunk_id = (r_start - 1) // {adapters.CHUNK}",
        ("mirhits", "genome"),
    ),
    "differential_bars": (
        lambda b: views.differential_bars(profiles.pairwise_fold(b.totals()).where("s1 = 'AF' AND s2 = 'RF' AND abs(log2(fold)) >= 0.2"), counting.length_tables(b.iso()), 20, "percent"),
        f"SELECT anno, read_len, sample, round(sum(ppm) * 100 / sum(sum(ppm)) OVER (PARTITION BY anno, read_len), 4) AS value FROM iso WHERE anno IN (SELECT anno FROM ({_FOLDS}) f WHERE s1 = 'AF' AND s2 = 'RF' AND abs(log2(fold)) >= 0.2 ORDER BY x + y DESC, anno LIMIT 20) GROUP BY anno, read_len, sample",
        ("totals",),
    ),
    "head_tail_n": (
        lambda b: views.head_tail_n(b.totals(), "ppm", 5, ["sample"], ["anno"]),
        "SELECT sample, anno, round(ppm, 4) AS ppm FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY ppm, anno) AS lo, row_number() OVER (PARTITION BY sample ORDER BY ppm DESC, anno DESC) AS hi FROM totals) x WHERE lo <= 5 OR hi <= 5",
        ("totals",),
    ),
    "filter_difference_arm": (
        lambda b: profiles.filter_difference_rows(profiles.arm_report(b.iso()), "Arm", min_expr=10.0),
        f"SELECT anno, sample, arm FROM (SELECT *, sum(t) OVER (PARTITION BY anno) AS total, count(*) OVER (PARTITION BY anno) AS n, count(*) OVER (PARTITION BY anno, arm) AS held FROM (SELECT anno, sample, arm, sum(p) OVER (PARTITION BY anno, sample) AS t, row_number() OVER (PARTITION BY anno, sample ORDER BY p DESC, arm) AS r FROM (SELECT {_PRE} AS anno, sample, {_ARM} AS arm, round(sum(ppm), 6) AS p FROM iso WHERE {_ARM} <> '' GROUP BY {_PRE}, sample, {_ARM}) y) x WHERE r = 1) z WHERE held = 1 AND n > 1 AND total >= 10",
        ("iso",),
    ),
    "filter_difference_loading": (
        lambda b: profiles.filter_difference_rows(profiles.loading_difference(b.iso_totals()).select("anno", "total", "diff", F.concat_ws(":", "max_sample", "min_sample").alias("samples"), F.lit("").alias("info")), "Loading", fold=0.5, min_expr=20.0),
        f"SELECT split_part(anno, '_', 1) AS anno, split_part(anno, '_', 2) AS seed, round(diff, 4) AS diff, max_sample AS sample1, min_sample AS sample2 FROM ({_LOADING.format(rows='isototals')}) x WHERE total >= 20 AND CASE WHEN diff > 0 THEN diff >= 0.5 ELSE diff <= 0.5 END",
        ("isototals",),
    ),
    "top_k": (
        lambda b: b.iso().groupBy("anno").agg(F.round(F.sum("ppm"), 4).alias("total")).orderBy(F.desc("total"), F.desc("anno")).limit(20),
        "SELECT anno, round(sum(ppm), 4) AS total FROM iso GROUP BY anno ORDER BY total DESC, anno DESC LIMIT 20",
        ("iso",),
    ),
    "assemble_features": (lambda b: b.assembled(), _ASSEMBLED, ("features",)),
    "assembled_type_counts": (lambda b: b.assembled().groupBy("biotype").agg(F.count("*").alias("n")), f"SELECT biotype, count(*) AS n FROM ({_ASSEMBLED}) a GROUP BY biotype", ("features",)),
    "ordered_hits": (
        lambda b: counting.ordered_hits(b.other_hits()),
        "SELECT tag_id, dense_rank() OVER (PARTITION BY tag_id ORDER BY k) AS place, biotype, name FROM (SELECT tag_id, name, CASE WHEN biotype = 'rmsk' THEN 'mirbase' ELSE biotype END AS biotype, coalesce(rk, 9) AS k, min(coalesce(rk, 9)) OVER (PARTITION BY tag_id) AS best FROM ranked) x WHERE k IN (best, 9)",
        ("ranked",),
    ),
    "ordered_hits_others": (
        lambda b: counting.ordered_hits(b.other_hits(), ["tRNA", "miRNA"], keep_other=True),
        "SELECT tag_id, dense_rank() OVER (PARTITION BY tag_id ORDER BY k) AS place, biotype, name FROM (SELECT tag_id, name, CASE WHEN biotype = 'rmsk' THEN 'mirbase' ELSE biotype END AS biotype, CASE biotype WHEN 'tRNA' THEN 1 WHEN 'miRNA' THEN 2 WHEN 'lincRNA' THEN 3 WHEN 'mirtron' THEN 4 ELSE 5 END AS k FROM hits) x",
        ("hits",),
    ),
    "match_biotype": (
        lambda b: counting.match_biotype(b.counts(), "miRNA_mirtron"),
        "SELECT sample, biotype, tail_class, read_len, round(ppm, 4) AS ppm FROM counts WHERE biotype IN ('miRNA', 'mirtron')",
        ("counts",),
    ),
    "length_window": (
        lambda b: counting.length_window(b.iso(), 20, 23).groupBy("sample", "anno").agg(F.sum("ppm").alias("ppm")),
        "SELECT sample, anno, round(sum(ppm), 4) AS ppm FROM iso WHERE read_len BETWEEN 20 AND 23 GROUP BY ALL",
        ("iso",),
    ),
    "filter_arm": (
        lambda b: counting.filter_arm(b.totals(), "5p"),
        "SELECT sample, anno, round(ppm, 4) AS ppm FROM totals WHERE anno LIKE '%-5p'",
        ("totals",),
    ),
    "token_length_tables": (
        lambda b: counting.token_length_tables(b.iso()),
        f"SELECT measure AS token, sample, anno, read_len, round(ppm, 4) AS value FROM ({_BY_MEASURE.format(keys='anno, read_len')}) m UNION ALL SELECT 'Tailing', sample, anno, read_len, round(sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END) * 100 / sum(ppm), 4) AS value FROM iso GROUP BY ALL HAVING sum(ppm) >= 1 AND sum(CASE WHEN tail_class <> 'GM' THEN ppm ELSE 0 END) > 0",
        ("iso",),
    ),
    "seed_totals": (
        lambda b: counting.seed_totals(b.iso()),
        "SELECT a.seed, s.sample, round(coalesce(t.ppm, 0), 4) AS ppm FROM (SELECT DISTINCT seed FROM iso) a CROSS JOIN (SELECT DISTINCT sample FROM iso) s LEFT JOIN (SELECT seed, sample, sum(ppm) AS ppm FROM iso GROUP BY ALL) t ON t.seed = a.seed AND t.sample = s.sample",
        ("iso",),
    ),
    "measure_folds": (
        lambda b: b.measure_folds(),
        f"SELECT measure, anno, s1, s2, round(x, 4) AS x, round(y, 4) AS y, round(fold, 4) AS fold, round(x + y, 4) AS total FROM ({_MEASURE_FOLDS}) f",
        ("iso",),
    ),
    "measure_preferences": (
        lambda b: profiles.preference_sets(b.measure_folds(), 1.2, None, ("measure", "anno")),
        f"SELECT measure, anno, sample, kind FROM (SELECT measure, anno, s1 AS sample, CASE WHEN count(*) FILTER (WHERE fold >= 1.2) = (SELECT count(DISTINCT sample) - 1 FROM iso) THEN 'UniLike' WHEN count(*) FILTER (WHERE fold <= 1 / 1.2) = (SELECT count(DISTINCT sample) - 1 FROM iso) THEN 'DisLike' END AS kind FROM ({_MEASURE_FOLDS}) f GROUP BY measure, anno, s1) x WHERE kind IS NOT NULL",
        ("iso",),
    ),
    "length_difference_samples": (
        lambda b: profiles.length_difference_samples(b.iso()),
        "SELECT anno, max(len) - min(len) AS diff, string_agg(sample, ',' ORDER BY sample) AS samples, string_agg(CAST(len AS VARCHAR), ',' ORDER BY sample) AS lengths FROM (SELECT anno, sample, read_len AS len, row_number() OVER (PARTITION BY anno, sample ORDER BY round(sum(ppm), 6) DESC, read_len) AS r FROM iso GROUP BY anno, sample, read_len) x WHERE r = 1 GROUP BY anno",
        ("iso",),
    ),
    "order_by_total": (
        lambda b: profiles.order_by_total(b.totals().groupBy("anno").agg(F.round(F.sum("ppm"), 6).alias("total"))),
        "SELECT anno, round(t, 4) AS total, row_number() OVER (ORDER BY t DESC, anno DESC) AS place FROM (SELECT anno, round(sum(ppm), 6) AS t FROM totals GROUP BY anno) x",
        ("totals",),
    ),
    "order_difference": (
        lambda b: profiles.order_difference(profiles.loading_difference(b.totals()).withColumn("total", F.round("total", 6))),
        f"SELECT anno, round(t, 4) AS total, round(diff, 4) AS diff, max_sample, min_sample, row_number() OVER (ORDER BY t DESC, anno) AS place FROM (SELECT *, round(total, 6) AS t FROM ({_LOADING.format(rows='totals')}) y) x",
        ("totals",),
    ),
    "pairwise_differential": (
        lambda b: b.folds(),
        f"SELECT anno, s1, s2, round(x, 4) AS x, round(y, 4) AS y, round(fold, 4) AS fold, round(x + y, 4) AS total, round(p, 4) AS p FROM ({_FOLDS_P}) f",
        ("totals",),
    ),
    "preference_significant": (lambda b: profiles.preference_sets(b.iso_folds()), _SIGNIFICANT, ("isototals",)),
    "preference_targets_significant": (
        lambda b: targets.preference_targets(profiles.preference_sets(b.iso_folds()), b.predictions()),
        f"SELECT DISTINCT sample, kind, gene, round(pct, 4) AS pct FROM ({_SIGNIFICANT}) p JOIN predictions t ON split_part(p.anno, '|', 1) = t.anno || '_' || translate(t.seed, 'T', 'U')",
        ("isototals", "predictions"),
    ),
    "differential_filter": (
        lambda b: views.filter_fold_pvalue(b.iso_folds()),
        f"SELECT anno, s1, s2, round(x, 4) AS x, round(y, 4) AS y, round(fold, 4) AS fold, round(x + y, 4) AS total, round(p, 4) AS p FROM ({_ISO_FOLDS_P}) f WHERE abs(log2(fold)) >= 1 AND p <= 0.05",
        ("isototals",),
    ),
    "volcano_points": (
        lambda b: views.volcano_points(b.folds(), 10.0, profiles.tail_profile(b.annotated()).select("sample", "anno", F.col("mean_tail_len").alias("colour"))),
        f"SELECT f.anno, s1, s2, round(log2(fold), 4) AS log2_fold, round(-log10(greatest(p, 1e-300)), 4) AS log10_p, round(coalesce(colour, 0), 4) AS colour FROM ({_FOLDS_P}) f LEFT JOIN (SELECT sample, anno, CASE WHEN sum(CASE WHEN tail <> '' THEN ppm ELSE 0 END) > 0 THEN sum(length(tail) * ppm) / sum(CASE WHEN tail <> '' THEN ppm ELSE 0 END) ELSE 0 END AS colour FROM annotated GROUP BY sample, anno) c ON c.sample = s1 AND c.anno = f.anno WHERE x + y > 10",
        ("totals",),
    ),
    "differential_summary": (
        lambda b: differential.differential_summary(differential.with_p(b.measure_folds()), b.measures(), ("measure", "anno")),
        f"SELECT measure, anno, round(t, 4) AS total, round(p, 4) AS min_p, row_number() OVER (ORDER BY t DESC, p, anno DESC, measure DESC) AS place FROM (SELECT measure, anno, round(sum(ppm), 6) AS t FROM ({_BY_MEASURE.format(keys='anno')}) m GROUP BY ALL) a JOIN (SELECT measure, anno, min(p) AS p FROM ({_MEASURE_FOLDS_P}) f GROUP BY ALL) b USING (measure, anno)",
        ("iso",),
    ),
    "region_expression": (
        lambda b: regions.region_expression(b.mir_hits(), _PLACE),
        "SELECT sample, mir, chrom, strand, f_start, round(sum(ppm), 4) AS ppm FROM mirhits GROUP BY ALL",
        ("mirhits",),
    ),
}
#: Queries that SQL can't express: chaining of strings.
UNSQL: dict[str, Build] = {
    "seed_chain": lambda b: regions.seed_chain(b.iso()),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, build=build: rounded(build(Base.of(spark, sf_dir)))) for name, build in ({n: r[0] for n, r in REPORTS.items()} | UNSQL).items()}


def oracle_sql() -> dict[str, str]:
    return {name: _with(_shifted(sql), needs) for name, (_, sql, needs) in REPORTS.items()}
