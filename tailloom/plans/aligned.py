"""Queries whose tags come from alignments: mismatches and T to C conversions are read from the MD tag.

The stages after the tags are those of ``reports``; in SQL, the tags' common table expression is another one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import counting, profiles, tags as tag_ops
from . import adapters
from .reports import _CTES, _NEEDS, _SEQUENCE, Base, Build


class Aligned(Base):
    """The stages over tags collapsed from alignments."""

    def parsed(self, allow_t2c: bool = True) -> DataFrame:
        return tag_ops.seed_mismatch_tag(tag_ops.parse_mismatches(tag_ops.decode_alignment(self.alignments()), allow_t2c))

    def collapsed(self) -> DataFrame:
        return tag_ops.collapse_tags(self.parsed())

    def source_tags(self) -> DataFrame:
        return tag_ops.tags_of(self.collapsed())

    def of_biotype(self, biotype: str) -> DataFrame:
        """Tags whose first biotype is that one, once each: their hits made distinct, which moves no other tags."""
        same = ["tag_id", "sample", "chrom", "strand", "t_start", "t_end", "tail", "md_tag", "tc_tag", "ppm"]
        return counting.match_biotype(self.annotated(), biotype).select(*same).distinct()

    def best_ranges(self) -> DataFrame:
        return profiles.best_ranges(self.annotated())


_TC = "(flag = 0 AND ref = 'T' AND base = 'C') OR (flag = 16 AND ref = 'A' AND base = 'G')"
CTES = _CTES | {
    "aligned": "SELECT *, CASE WHEN flag = 0 THEN '+' ELSE '-' END AS strand, 'chr' || rname AS chrom, CAST(regexp_extract(cigar, '(\\d+)M', 1) AS INT) AS gm_len FROM alignments",
    "steps": "SELECT *, CASE WHEN flag = 16 THEN right(seq, gm_len) ELSE left(seq, gm_len) END AS matched, list_transform(regexp_extract_all(md, '(\\d+)[ACGT]', 1), lambda x: CAST(x AS INT)) AS n, regexp_extract_all(md, '\\d+([ACGT])', 1) AS refs FROM aligned",
    # a row for each mismatch: it lies after the steps so far and the mismatches before it
    "changes": "SELECT *, CASE WHEN flag = 16 THEN gm_len - 1 - ofs ELSE ofs END AS place, CASE WHEN flag = 16 THEN translate(base, 'ACGT', 'TGCA') ELSE base END AS shown, " + _TC + " AS tc FROM (SELECT *, refs[i] AS ref, substring(matched, ofs + 1, 1) AS base FROM (SELECT *, CAST(list_sum(n[1:i]) + i - 1 AS INT) AS ofs FROM (SELECT *, unnest(range(1, len(n) + 1)) AS i FROM steps) a) b) c",
    "texts": "SELECT qname, coalesce(string_agg(place || shown, '' ORDER BY place) FILTER (WHERE NOT tc), '') AS md_tag, coalesce(string_agg(place || 'C', '' ORDER BY place) FILTER (WHERE tc), '') AS tc_tag, coalesce(string_agg((place - 1) || shown, '' ORDER BY place) FILTER (WHERE NOT tc AND place BETWEEN 1 AND 7), '') AS seed_md FROM changes GROUP BY qname",
    "templates": "SELECT qname, CASE WHEN flag = 16 THEN reverse(translate(plus, 'ACGT', 'TGCA')) ELSE plus END AS templated FROM (SELECT s.qname, s.flag, string_agg(coalesce(c.ref, substring(s.matched, CAST(s.p AS INT) + 1, 1)), '' ORDER BY s.p) AS plus FROM (SELECT *, unnest(range(gm_len)) AS p FROM steps) s LEFT JOIN changes c ON c.qname = s.qname AND c.ofs = s.p GROUP BY s.qname, s.flag) x",
    "parsed": "SELECT s.*, coalesce(t.md_tag, '') AS md_tag, coalesce(t.tc_tag, '') AS tc_tag, coalesce(t.seed_md, '') AS seed_md FROM steps s LEFT JOIN texts t ON t.qname = s.qname",
    "tags0": "SELECT sample, min(p.qname) AS tag_id, chrom, strand, pos AS t_start, pos + gm_len AS t_end, gm_len, tl AS tail, count(*) AS reads, min(nh) AS nh, max(templated) AS seq, md_tag, tc_tag, max(seed_md) AS seed_md FROM parsed p JOIN templates m ON m.qname = p.qname GROUP BY sample, chrom, strand, pos, gm_len, tl, md_tag, tc_tag",
    "annotated": "SELECT t.*, p.biotype, p.name AS anno, translate(substring(t.seq, 2, 7), 'T', 'U') || CASE WHEN seed_md <> '' THEN '|' || translate(seed_md, 'T', 'U') ELSE '' END AS seed, t.gm_len AS read_len, CASE WHEN tail = '' THEN 'GM' WHEN tail = 'A' THEN 'A' WHEN tail = 'C' THEN 'C' WHEN tail = 'G' THEN 'G' WHEN tail = 'TT' THEN 'U' ELSE 'Other' END AS tail_class FROM tags t JOIN prime p ON t.tag_id = p.tag_id",
    "iso": "SELECT sample, biotype, anno, seed, tail_class, read_len, sum(ppm) AS ppm FROM annotated GROUP BY ALL",
    "places": "SELECT tag_id, CAST(unnest(regexp_extract_all(md_tag, '(\\d+)[ACGT]', 1)) AS INT) AS ofs, unnest(regexp_extract_all(md_tag, '\\d+([ACGT])', 1)) AS base, 'MD' AS kind FROM tags UNION ALL SELECT tag_id, CAST(unnest(regexp_extract_all(tc_tag, '(\\d+)C', 1)) AS INT), 'C', 'TC' FROM tags",
    "reads": "SELECT sample, anno, seed, tag_id, ppm, tail, translate(seq || tail, 'T', 'U') AS whole FROM annotated",
    # mean over a key's range
    "ranges": "SELECT anno, chrom, strand, CASE WHEN strand = '+' THEN t_start ELSE t_start - 2 END AS s, CASE WHEN strand = '+' THEN t_end + 2 ELSE t_end END AS e, CASE WHEN strand = '+' THEN t_start + 8 ELSE t_end - 8 END AS d, count(*) AS n FROM annotated GROUP BY ALL",
    "merged": "SELECT anno, chrom, strand, min(s) AS r_start, max(e) AS r_end, CASE WHEN strand = '+' THEN max(d) ELSE min(d) END AS seed_end, CAST(sum(n) AS BIGINT) AS support FROM (SELECT *, sum(new) OVER (PARTITION BY anno, chrom, strand ORDER BY s, e) AS island FROM (SELECT *, CASE WHEN s > coalesce(max(e) OVER (PARTITION BY anno, chrom, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1000000000000) THEN 1 ELSE 0 END AS new FROM ranges) x) y GROUP BY anno, chrom, strand, island",
    "best": "SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY anno ORDER BY support DESC, chrom, strand, r_start) AS r FROM merged) x WHERE r = 1",
    "bases": """SELECT anno, chrom, strand, CASE WHEN strand = '+' THEN t_start + i ELSE t_end - 1 - i END AS pos, ppm, CASE WHEN i < gm_len THEN ppm ELSE 0 END AS templated, CASE WHEN kind = 'MD' THEN ppm ELSE 0 END AS mismatch, CASE WHEN kind = 'TC' THEN ppm ELSE 0 END AS tc, CASE WHEN i >= gm_len THEN substring(translate(tail, 'T', 'U'), CAST(i - gm_len AS INT) + 1, 1) ELSE translate(base, 'T', 'U') END AS nt
FROM (SELECT *, unnest(range(gm_len + length(tail))) AS i FROM annotated) a LEFT JOIN places p ON p.tag_id = a.tag_id AND p.ofs = a.i""",
}
NEEDS = _NEEDS | {"aligned": ["alignments"], "steps": ["aligned"], "changes": ["steps"], "texts": ["changes"], "templates": ["steps", "changes"], "parsed": ["steps", "texts"], "tags0": ["parsed", "templates"], "places": ["tags"], "reads": ["annotated"], "ranges": ["annotated"], "merged": ["ranges"], "best": ["merged"], "bases": ["annotated", "places"]}
_SLOTS = "SELECT r.*, x.slot, CAST(CASE WHEN x.slot < 8 THEN x.i WHEN x.slot < 13 THEN length(whole) - 1 - x.i ELSE length(whole) - 5 + x.i END AS INT) AS ofs FROM reads r JOIN (SELECT i AS slot, i FROM range(8) a(i) UNION ALL SELECT 8 + i, i FROM range(5) b(i) UNION ALL SELECT s, i FROM range(4) c(i), (VALUES (13), (14)) d(s)) x ON x.slot < 8 OR (x.slot < 14 AND tail <> '') OR (x.slot = 14 AND tail = '')"
_SEED_AT = "CASE WHEN strand = '+' THEN r_start ELSE seed_end - 1 END"
_SEED_SEQUENCE = _SEQUENCE.format(s=f"substring(chunk, CAST(({_SEED_AT}) % {adapters.CHUNK} + 1 AS INT), CAST(CASE WHEN strand = '+' THEN seed_end - r_start - 1 ELSE r_end - seed_end - 1 END AS INT))")

REPORTS: dict[str, tuple[Build, str, tuple[str, ...]]] = {
    "parse_mismatches": (lambda b: b.parsed().select("sample", "qname", "md_tag", "tc_tag"), "SELECT sample, qname, md_tag, tc_tag FROM parsed", ("parsed",)),
    "parse_mismatches_plain": (
        lambda b: b.parsed(False).select("sample", "qname", "md_tag", F.size("tc_pos").alias("conversions")),
        "SELECT sample, s.qname, coalesce(md_tag, '') AS md_tag, 0 AS conversions FROM steps s LEFT JOIN (SELECT qname, string_agg(place || shown, '' ORDER BY place) AS md_tag FROM changes GROUP BY qname) c ON c.qname = s.qname",
        ("steps", "changes"),
    ),
    "seed_mismatch_tag": (lambda b: b.parsed().groupBy("sample", "seed_md").agg(F.count("*").alias("n")), "SELECT sample, seed_md, count(*) AS n FROM parsed GROUP BY ALL", ("parsed",)),
    "collapse_tags": (
        lambda b: b.collapsed().select("sample", "strand", "chrom", "pos", "t_end", "md_tag", "tc_tag", "tl", "reads", "nh"),
        "SELECT sample, strand, chrom, t_start AS pos, t_end, md_tag, tc_tag, tail AS tl, reads, nh FROM tags0",
        ("tags0",),
    ),
    "collapsed_sequences": (lambda b: tag_ops.tags_of(b.collapsed()).select("tag_id", "seq", "seed_md"), "SELECT tag_id, seq, seed_md FROM tags0", ("tags0",)),
    "mismatch_kinds": (
        lambda b: profiles.mismatch_kinds(b.of_biotype("miRNA_mirtron")),
        "SELECT sample, kind, ofs + 1 AS pos, round(sum(ppm), 4) AS ppm FROM tags t JOIN places p ON p.tag_id = t.tag_id WHERE t.tag_id IN (SELECT tag_id FROM prime WHERE biotype IN ('miRNA', 'mirtron')) GROUP BY ALL",
        ("places", "prime"),
    ),
    "isoform_counts_aligned": (lambda b: b.iso(), "SELECT sample, biotype, anno, seed, tail_class, read_len, round(ppm, 4) AS ppm FROM iso", ("iso",)),
    "position_profile": (
        lambda b: profiles.position_profile(b.seeded()),
        f"SELECT sample, anno, seed, CAST(slot AS INT) AS slot, CASE WHEN tc.ofs IS NOT NULL THEN 'U' ELSE coalesce(translate(md.base, 'T', 'U'), substring(whole, s.ofs + 1, 1)) END AS nt, round(sum(ppm), 4) AS ppm FROM ({_SLOTS}) s LEFT JOIN places md ON md.tag_id = s.tag_id AND md.ofs = s.ofs AND md.kind = 'MD' LEFT JOIN places tc ON tc.tag_id = s.tag_id AND tc.ofs = s.ofs AND tc.kind = 'TC' WHERE s.ofs >= 0 AND s.ofs < length(whole) GROUP BY ALL",
        ("reads", "places"),
    ),
    "best_ranges": (lambda b: b.best_ranges(), "SELECT anno, chrom, r_start, r_end, strand, seed_end, support FROM best", ("best",)),
    "seed_sequences": (
        lambda b: profiles.seed_sequences(b.best_ranges(), b.iso(), b.genome(), adapters.CHUNK),
        f"SELECT mir, round(any_value(p), 4) AS mean_ppm, max(s) FILTER (WHERE arm = '5p') AS seed5, max(s) FILTER (WHERE arm = '3p') AS seed3 FROM (SELECT regexp_replace(anno, '-[35]p$', '') AS mir, regexp_extract(anno, '-([35]p)$', 1) AS arm, translate({_SEED_SEQUENCE}, 'T', 'U') AS s FROM best b JOIN genome g ON g.chrom = b.chrom AND g.chunk_id = ({_SEED_AT}) // {adapters.CHUNK}) x JOIN (SELECT regexp_replace(anno, '-[35]p$', '') AS mir, sum(ppm) / (SELECT count(DISTINCT sample) FROM iso) AS p FROM iso GROUP BY 1) i USING (mir) WHERE arm <> '' GROUP BY mir",
        ("best", "genome", "iso"),
    ),
    "pileup_coverage": (
        lambda b: profiles.pileup_coverage(b.annotated()),
        "SELECT anno, chrom, strand, pos, round(ppm, 4) AS ppm, round(templated, 4) AS templated, round(mismatch, 4) AS mismatch, round(tc, 4) AS tc, "
        + ", ".join(f"round({c}, 4) AS {c}" for c in "acgu")
        + ", round(ppm * 100 / max(ppm) OVER (PARTITION BY anno, chrom, strand), 4) AS scaled, "
        + ", ".join(f"round({c} / (templated + a + c + g + u), 4) AS share_{c}" for c in ("templated", "a", "c", "g", "u"))
        + " FROM (SELECT anno, chrom, strand, pos, sum(ppm) AS ppm, sum(templated) AS templated, sum(mismatch) AS mismatch, sum(tc) AS tc, "
        + ", ".join(f"sum(CASE WHEN nt = '{c.upper()}' THEN ppm ELSE 0 END) AS {c}" for c in "acgu")
        + " FROM bases GROUP BY anno, chrom, strand, pos) x",
        ("bases",),
    ),
}
