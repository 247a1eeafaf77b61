"""Registered queries: sections and disease cohorts (D11, D12, A06, J17,
D23, A12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelab.operators import knowledge as kn
from notelab.operators import measures as ms
from notelab.operators import sections as sc
from notelab.plans import sql_measures as sm
from notelab.plans import testbed as tb
from notelab.plans.registry import query

W = tb.with_ctes
_DIS = "[" + ", ".join(f"'{d}'" for d in sc.DISEASES) + "]"
_CONCEPTS = "CUI_per_section"


def _key(x: str) -> str:
    return f"trim(regexp_replace({sm.norm(x)}, '['' ]+', ' ', 'g'))"


_SECTIONS_SQL = f"""
headings as (select {_key('h')} k, section from (values {', '.join(f"({sm.q(h)}, {sm.q(s)})" for h, s in sc.SECTION_HEADINGS)}) v(h, section)),
opened as (select conv_id, l, section from (
             select conv_id, l, {_key("regexp_extract(line, '^[ \t]*([^:]*)', 1)")} k
             from (select conv_id, unnest(string_split(note_text, chr(10))) line,
                          generate_subscripts(string_split(note_text, chr(10)), 1) l from d_section_notes) a) b
           join headings using (k)),
starts as (select o.conv_id, o.section, cast(coalesce(list_sum(list_transform(string_split(n.note_text, chr(10))[1:o.l - 1], lambda x: length(x) + 1)), 0) as integer) start,
                  cast(length(n.note_text) as integer) len
           from opened o join d_section_notes n on n.conv_id = o.conv_id),
secs as (select conv_id, start, coalesce(lead(start) over (partition by conv_id order by start), len) "end", section from starts)"""


def _notes(spark, sf_dir):
    return tb.d_section_notes(tb.tables(spark, sf_dir).conversations)


def _sections(spark, sf_dir):
    return sc.detect_sections(_notes(spark, sf_dir), "conv_id", "note_text", sc.section_headings(spark))


@query("D11_detect_sections", W('select conv_id, start, "end", section from secs', "d_section_notes", extra=_SECTIONS_SQL))
def d11(spark, sf_dir):
    return _sections(spark, sf_dir)


# five words of a benchmark item, two that overlap them, one that lies inside, and
# the two words before; all of them occur inside the texts
_TERM_WORDS = ((2, 5), (6, 2), (4, 1), (1, 2))


def d_phrases(benchmark):
    """Terminology of one to five words: ``term, code``."""
    words = F.split(sc.folded_words(F.col("text")), " ")
    parts = F.array(*[F.struct(F.array_join(F.slice(words, a, n), "-").alias("term"),
                               F.concat(F.lit(f"T{n}-"), F.col("item_id").cast("string")).alias("code")) for a, n in _TERM_WORDS])
    return benchmark.select(F.explode(parts).alias("x")).select("x.term", "x.code").where("term != ''")


_AHEAD = ", ".join("{'e': lead(e, %d) over w, 'f': %s}" % (n, " || ' ' || ".join(f"lead(m, {i}) over w" for i in range(n + 1)))
                   for n in range(5))
def _tagged(src: str, note: str, text: str) -> str:
    """CTEs up to ``tagged`` (note, s, e, term, code) for terms of one to five words
    in ``terms`` (folded, term, code)."""
    return f"""
folded as materialized (select folded, min(term) term, min(code) code from terms where folded <> '' group by folded),
words as (select {note}, m, start s, cast(start + length(m) as integer) e
          from {sm.find_all(src, note, text, '[a-z0-9]+', ())} x),
runs as (select {note}, s, unnest([{_AHEAD}]) x from words window w as (partition by {note} order by s)),
hits as materialized (select {note}, s, x.e e, term, code from runs join folded on folded = x.f),
ranked as materialized (select {note}, {{'s': s, 'e': e, 'term': term, 'code': code}} own,
                               row_number() over (partition by {note} order by e - s desc, s) r from hits),
greedy as (
  select {note}, r, [{{'s': own.s, 'e': own.e}}] kept, own from ranked where r = 1
  union all
  select {note}, r, case when clash then kept else list_append(kept, {{'s': own.s, 'e': own.e}}) end, case when clash then null else own end
  from (select y.*, g.kept, len(list_filter(g.kept, lambda z: least(z.e, y.own.e) > greatest(z.s, y.own.s))) > 0 clash
        from greedy g join ranked y on y.{note} = g.{note} and y.r = g.r + 1) x),
tagged as (select {note}, own.s s, own.e e, own.term term, own.code code from greedy where own is not null)"""


_PHRASES_SQL = f"""with recursive
terms as (select 'T' || n || '-' || item_id code, array_to_string(words[a:a + n - 1], '-') term,
                 array_to_string(words[a:a + n - 1], ' ') folded
          from (select item_id, regexp_extract_all({sm.norm('text')}, '[a-z0-9]+', 0) words from benchmark) b,
               (values {', '.join(str(x) for x in _TERM_WORDS)}) v(a, n)),{_tagged('documents', 'doc_id', 'text')}
select doc_id, s, e, code from tagged"""


@query("D01_tag_phrases", _PHRASES_SQL)
def d01_phrases(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    return sc.tag_mentions(t.documents, d_phrases(t.benchmark), ["doc_id"], "text").select("doc_id", "s", "e", "code")


# the knowledge by its rule, without the JSON
_COHORT_CTES = _SECTIONS_SQL + f""",
terms as (select term, code, replace(term, '-', ' ') folded from d_section_terms),{_tagged('d_section_notes', 'conv_id', 'note_text')},
codes as (select conv_id, turn, conv_id * 8 + turn c, unnest(case when (conv_id * 8 + turn) % 7 = 0 then [0, 1] else [0] end) more from conversations),
kb as (select distinct {_DIS}[(c + more) % 4 + 1] disease, 'analyte_' || (c % 3) analyte, 'C' || c code,
              case c % 5 when 0 then 'SECTION_examen_complementaire' when 1 then 'SECTION_antecedent' end only_in from codes),
placed as (select m.*, x.section from tagged m join secs x
           on x.conv_id = m.conv_id and least(m.e, x."end") > greatest(m.s, x.start)),
d12 as (select conv_id, section, disease, analyte, list_sort(list(term)) terms
        from (select distinct p.conv_id, p.s, p.e, p.term, p.section, kb.disease, kb.analyte
              from placed p join kb on kb.code = p.code and (kb.only_in is null or kb.only_in = p.section)) t
        group by conv_id, section, disease, analyte)"""


def _cohort_sql(sql: str) -> str:
    return W(sql, "d_section_notes", "d_section_terms", extra=_COHORT_CTES).replace("with ", "with recursive ", 1)


def _tagged_mentions(spark, sf_dir):
    terms = tb.d_section_terms(tb.tables(spark, sf_dir).conversations)
    return sc.tag_mentions(_notes(spark, sf_dir), terms, ["conv_id"], "note_text").withColumn("codes", F.array("code"))


def _knowledge(spark, sf_dir):
    return kn.knowledge_rows(tb.d_knowledge(tb.tables(spark, sf_dir).conversations), sc.section_headings(spark))


def _stats(spark, sf_dir):
    kb = kn.concepts(_knowledge(spark, sf_dir), _CONCEPTS)
    return sc.section_stats(_tagged_mentions(spark, sf_dir), _sections(spark, sf_dir), kb, "conv_id")


@query("D12_section_stats", _cohort_sql("select * from d12"))
def d12(spark, sf_dir):
    return _stats(spark, sf_dir)


@query("A06_section_summary", _cohort_sql("""
select conv_id, section, map_from_entries(list({'key': disease, 'value': analytes} order by disease)) summary
from (select conv_id, section, disease,
             map_from_entries(list({'key': analyte, 'value': terms} order by analyte)) analytes
      from d12 group by conv_id, section, disease) t
group by conv_id, section"""))
def a06(spark, sf_dir):
    return sc.section_summary(_stats(spark, sf_dir), "conv_id")


@query("J17_dictionary_lookup", _cohort_sql("""
select distinct m.conv_id, m.s, kb.disease, kb.analyte from tagged m join kb on kb.code = m.code"""))
def j17(spark, sf_dir):
    kb = kn.concepts(_knowledge(spark, sf_dir), _CONCEPTS)
    return sc.dictionary_lookup(_tagged_mentions(spark, sf_dir), kb, ["conv_id", "s"])


@query("D23_disease_knowledge", W(f"""
select distinct disease, kind, only_in, analyte, code from (
  select disease, '{_CONCEPTS}' kind, only_in, analyte, code from kb
  union all
  select disease, 'ANABIO_codes', null, analyte, replace(code, 'C', 'L') from kb
  union all
  select {_DIS}[(c + more) % 4 + 1], 'CIM10', null, null, 'M' || conv_id from codes where turn = 0) t""",
                                  "d_section_notes", "d_section_terms", extra=_COHORT_CTES).replace("with ", "with recursive ", 1))
def d23_knowledge(spark, sf_dir):
    """The nested entries as rows."""
    return _knowledge(spark, sf_dir)


@query("D23_cohort_by_disease", _cohort_sql(f"""
select disease, conv_id, list_sort(list(distinct kind)) kinds from (
  select kb.disease, p.conv_id, '{_CONCEPTS}' kind
  from placed p join kb on kb.code = p.code and (kb.only_in is null or kb.only_in = p.section)
  union all
  select kb.disease, c.conv_id, 'ANABIO_codes' from (select distinct conv_id, turn from conversations where turn % 4 = 1) c
  join kb on kb.code = 'C' || (c.conv_id * 8 + 8 + c.turn)
  union all
  select {_DIS}[(k.c + k.more) % 4 + 1], c.conv_id, 'CIM10' from (select distinct conv_id from conversations) c
  join codes k on k.conv_id = c.conv_id // 2 and k.turn = 0) t
group by disease, conv_id"""))
def d23(spark, sf_dir):
    """Diagnoses of the stays, codes of the laboratory and concepts in the notes."""
    conversations = tb.tables(spark, sf_dir).conversations
    placed = sc.place_mentions(_tagged_mentions(spark, sf_dir), _sections(spark, sf_dir), "conv_id")
    none = F.lit(None).cast("string").alias("section")
    diagnoses = conversations.select("conv_id", F.lit("CIM10").alias("kind"), none, F.concat(
        F.lit("M"), F.floor(F.col("conv_id") / 2).cast("string")).alias("code"))
    labs = conversations.where(F.col("turn") % 4 == 1).select("conv_id", F.lit("ANABIO_codes").alias("kind"), none, F.concat(
        F.lit("L"), (F.col("conv_id") * 8 + 8 + F.col("turn")).cast("string")).alias("code"))
    found = placed.select("conv_id", F.lit(_CONCEPTS).alias("kind"), "section", F.explode("codes").alias("code"))
    return kn.cohort_by_disease(found.unionByName(labs).unionByName(diagnoses), _knowledge(spark, sf_dir), "conv_id")


@query("A12_measurement_stats_per_analyte", W(f"""
select analyte, count(distinct source) n_notes, count(*) n_mentions, count(*) / count(distinct source) per_note,
       quantile_cont(base_value, 0.25) p25, quantile_cont(base_value, 0.5) p50, quantile_cont(base_value, 0.75) p75
from {sm.measures('d_lab_lines', 'source, ln, analyte', 'line')} x group by analyte""",
                                               "d_lab_lines", extra=sm.unit_ctes()))
def a12(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    lines = tb.d_lab_lines(t.orders, t.lineitem, t.part)
    m = lines.select("source", "analyte", F.explode(ms.extract_measures(F.col("line"))).alias("m")).select(
        "source", "analyte", "m.base_value")
    return sc.measurement_stats(m, ["analyte"], "source")
