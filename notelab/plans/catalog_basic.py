"""Registered queries: scalar text functions (X01-X12, X16), filters
(P01-P14) and set operations (U01-U04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from notelab.functions import text as tx
from notelab.operators import filters as fl
from notelab.plans import testbed as tb
from notelab.plans.registry import query

W = tb.with_ctes

# -- X01..X04 on whole note texts ---------------------------------------------


@query("X01_normalize_term_notes",
       f"select doc_id, {tx.normalize_term_sql('text')} norm from documents")
def x01_notes(spark, sf_dir):
    d = tb.tables(spark, sf_dir).documents
    return d.select("doc_id", tx.normalize_term(F.col("text")).alias("norm"))


@query("X01_normalize_term_dictionary",
       W(f"select CUI, CODE, {tx.normalize_term_sql('STR', cased=False, rm_stopwords=True, rm_special=True)} norm "
         "from d_mrconso", "d_mrconso"))
def x01_dict(spark, sf_dir):
    m = tb.d_mrconso(tb.tables(spark, sf_dir).part)
    return m.select("CUI", "CODE", tx.normalize_term(F.col("STR"), cased=False, rm_stopwords=True,
                                                     rm_special=True).alias("norm"))


@query("X02_fold_ascii", f"select doc_id, {tx.fold_ascii_sql('text')} folded from documents")
def x02(spark, sf_dir):
    d = tb.tables(spark, sf_dir).documents
    return d.select("doc_id", tx.fold_ascii(F.col("text")).alias("folded"))


# two letters of Latin Extended Additional in front of every text
_WIDE = "chr(cast(7840 + doc_id % 90 as integer)) || chr(cast(7680 + doc_id % 150 as integer)) || text"


@query("X02_fold_all_code_points", f"select doc_id, {tx.fold_ascii_sql(f'strip_accents({_WIDE})')} folded from documents")
def x02_all(spark, sf_dir):
    wide = [F.call_function("decode", F.unhex(F.lpad(F.hex(F.lit(base) + F.col("doc_id") % n), 4, "0")), F.lit("UTF-16BE"))
            for base, n in ((7840, 90), (7680, 150))]
    docs = tb.tables(spark, sf_dir).documents
    return docs.select("doc_id", tx.fold_ascii_all(F.concat(*wide, "text")).alias("folded"))


@query("X03_remove_stopwords",
       f"select doc_id, regexp_replace({tx.fold_ascii_sql('text')}, '{tx.stopword_pattern(tx.DEFAULT_STOPWORDS)}', "
       "'', 'g') cleaned from documents")
def x03(spark, sf_dir):
    d = tb.tables(spark, sf_dir).documents
    return d.select("doc_id", tx.remove_stopwords(tx.fold_ascii(F.col("text"))).alias("cleaned"))


@query("X04_remove_special",
       f"select doc_id, regexp_replace({tx.fold_ascii_sql('text')}, '[^a-zA-Z0-9\\s]', ' ', 'g') cleaned "
       "from documents")
def x04(spark, sf_dir):
    d = tb.tables(spark, sf_dir).documents
    return d.select("doc_id", tx.remove_special(tx.fold_ascii(F.col("text"))).alias("cleaned"))


# -- X06..X12, X16 ------------------------------------------------------------

_X06_SQL = W(f"""
select source, k, term, variants,
       case when len(variants) = 0 then term else regexp_replace(term, '(?i)\\b(?:' || array_to_string(
         list_transform(list_sort(list_transform(list_distinct(variants), lambda x: {{'l': -length(x), 's': x}})),
                        lambda y: '\\Q' || y.s || '\\E'), '|') || ')\\b', '', 'g') end stripped
from (select source, k, {tx.fold_ascii_sql('term')} term,
             list_filter(string_split({tx.fold_ascii_sql('term')}, ' ')[2:3], lambda x: x <> '') variants
      from d_keys) t""", "d_keys")


@query("X06_remove_variants", _X06_SQL)
def x06(spark, sf_dir):
    k = tb.d_keys(tb.tables(spark, sf_dir).documents).select("source", "k", tx.fold_ascii(F.col("term")).alias("term"))
    k = k.withColumn("variants", F.filter(F.slice(F.split("term", " "), 2, 2), lambda x: x != ""))
    return k.select("source", "k", "term", "variants",
                    tx.remove_variants(F.col("term"), F.col("variants")).alias("stripped"))


@query("X07_find_subspan", W("""
select i.source, i.k, k.s + instr(k.term, i.term) - 1 sub_start,
       k.s + instr(k.term, i.term) - 1 + length(i.term) sub_end
from d_inner i join d_keys k on i.source = k.source and k.k = i.k // 3""", "d_keys", "d_inner"))
def x07(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    keys = tb.d_keys(docs).select("source", F.col("k").alias("kk"), F.col("s").alias("ks"), F.col("term").alias("kterm"))
    inner = tb.d_inner(docs).select("source", "k", "term", F.expr("k div 3").alias("kk"))
    j = inner.join(keys, ["source", "kk"])
    start, end = tx.find_subspan(F.col("ks"), F.col("kterm"), F.col("term"))
    return j.select("source", "k", start.alias("sub_start"), end.alias("sub_end"))


@query("X08_term_from_path", W("""
select c_basecode, regexp_replace(split_part(substring(c_name, instr(c_name, ':') + 1), '_', 1), '^\\s+|\\s+$', '', 'g') term
from d_onto""", "d_onto"))
def x08(spark, sf_dir):
    o = tb.d_onto(tb.tables(spark, sf_dir).part)
    return o.select("c_basecode", tx.term_from_path(F.col("c_name")).alias("term"))


@query("X09_split_annotation", W("""
select source, k,
       case when annotation is null then cast([] as varchar[]) else [string_split(annotation, '_')[1]] end code,
       case when annotation is null or not contains(annotation, '_') then cast([] as varchar[])
            else [substring(annotation, strpos(annotation, '_') + 1)] end measure
from d_gold""", "d_gold"))
def x09(spark, sf_dir):
    g = tb.d_gold(tb.tables(spark, sf_dir).documents)
    code, meas = tx.split_annotation(F.col("annotation"))
    return g.select("source", "k", code.alias("code"), meas.alias("measure"))


@query("X10_build_annotation", W("""
select source, k, array_to_string(codes, '/') || '_' || replace(array_to_string(found, '/'), ' ', '') annotation
from d_pred""", "d_pred"))
def x10(spark, sf_dir):
    p = tb.d_pred(tb.tables(spark, sf_dir).documents)
    return p.select("source", "k", tx.build_annotation(F.col("codes"), F.col("found")).alias("annotation"))


_NGRAM_SQL = ("list_sort(list_distinct(list_transform(range(1, greatest(length('##' || {x} || '##') - 2, 1) + 1), "
              "lambda i: substring('##' || {x} || '##', i, 3))))")


@query("X11_ngram_set", W(f"select id, {_NGRAM_SQL.format(x='term')} grams from d_terms", "d_terms"))
def x11(spark, sf_dir):
    t = tb.d_terms(tb.tables(spark, sf_dir).part)
    return t.select("id", F.array_sort(tx.ngram_set(F.col("term"), 3)).alias("grams"))


@query("X12_sorensen_dice", W(f"""
select id, gid, 2 * len(list_intersect(a, b)) / (len(a) + len(b)) dice
from (select t.id, g.gid, {_NGRAM_SQL.format(x='t.term')} a, {_NGRAM_SQL.format(x='g.gold_term')} b
      from d_terms t join d_gold_terms g on g.gid = t.id + 1) q""", "d_terms", "d_gold_terms"))
def x12(spark, sf_dir):
    part = tb.tables(spark, sf_dir).part
    t, g = tb.d_terms(part), tb.d_gold_terms(part)
    j = t.join(g, g.gid == t.id + 1)
    return j.select("id", "gid", tx.dice(tx.ngram_set(F.col("term"), 3),
                                         tx.ngram_set(F.col("gold_term"), 3)).alias("dice"))


@query("X16_value_unit_text", W(f"""
select encounter_num, concept_cd, concat_ws(' ', {tx.number_text_sql('nval_num')}, units_cd) value_text
from d_labs""", "d_labs"))
def x16(spark, sf_dir):
    labs = tb.d_labs(tb.tables(spark, sf_dir).lineitem)
    return labs.select("encounter_num", "concept_cd",
                       tx.value_unit_text(F.col("nval_num"), F.col("units_cd")).alias("value_text"))


# -- P01..P14 -----------------------------------------------------------------

_SPAN_SQL_INPUT = """
select source, k, case when k % 3 = 2 then concat(cast(s as varchar), ' ', cast(s + 10 as varchar), ';',
                                                   cast(s + 11 as varchar), ' ', cast(e as varchar))
                       else concat(cast(s as varchar), ' ', cast(e as varchar)) end span
from d_inner"""


@query("P01_parse_span", W(f"""
select source, k, cast(regexp_extract(span, '^(\\d+).*\\s(\\d+)$', 1) as integer) span_start,
       cast(regexp_extract(span, '^(\\d+).*\\s(\\d+)$', 2) as integer) span_end
from ({_SPAN_SQL_INPUT}) t""", "d_inner"))
def p01(spark, sf_dir):
    i = tb.d_inner(tb.tables(spark, sf_dir).documents)
    span = F.when(F.col("k") % 3 == 2, F.concat_ws(" ", F.col("s").cast("string"),
                                                   F.concat((F.col("s") + 10).cast("string"), F.lit(";"),
                                                            (F.col("s") + 11).cast("string")),
                                                   F.col("e").cast("string"))
                  ).otherwise(F.concat_ws(" ", F.col("s").cast("string"), F.col("e").cast("string")))
    s, e = fl.parse_span(span)
    return i.select("source", "k", s.alias("span_start"), e.alias("span_end"))


@query("P02_keep_labels", W("""
select source, k, label from d_mentions where label in ('BIO_comp', 'BIO')""", "d_mentions"))
def p02(spark, sf_dir):
    m = tb.d_mentions(tb.tables(spark, sf_dir).documents)
    return fl.keep_labels(m, ["BIO_comp", "BIO"]).select("source", "k", "label")


@query("P03_select_rename", W("""
select source, k gold_k, term gold_term, label label_type from d_gold""", "d_gold"))
def p03(spark, sf_dir):
    g = tb.d_gold(tb.tables(spark, sf_dir).documents)
    return fl.rename(g, {"k": "gold_k", "term": "gold_term", "label": "label_type"},
                     drop=["doc_id", "s", "e", "annotation"])


@query("P04_not_null", W("""
select encounter_num, concept_cd, nval_num from d_labs where nval_num is not null""", "d_labs"))
def p04(spark, sf_dir):
    labs = tb.d_labs(tb.tables(spark, sf_dir).lineitem)
    return fl.not_null(labs, "nval_num").select("encounter_num", "concept_cd", "nval_num")


@query("P05_fill_default", W("""
select encounter_num, concept_cd, coalesce(units_cd, 'nounit') unit from d_labs""", "d_labs"))
def p05(spark, sf_dir):
    labs = tb.d_labs(tb.tables(spark, sf_dir).lineitem)
    return labs.select("encounter_num", "concept_cd", fl.fill_default(F.col("units_cd"), "nounit").alias("unit"))


@query("P06_conditional_overwrite", W("""
select source, k, case when contains(annotation, '_') then split_part(annotation, '_', 1)
                       when contains(annotation, ':') then split_part(annotation, ':', 2)
                       else annotation end gold_label
from d_gold where annotation is not null""", "d_gold"))
def p06(spark, sf_dir):
    g = tb.d_gold(tb.tables(spark, sf_dir).documents).where(F.col("annotation").isNotNull())
    return g.select("source", "k", tx.conditional_code(F.col("annotation")).alias("gold_label"))


@query("P07_any_code_of_interest", W("""
select source, k, codes from d_pred where list_has_any(codes, ['C1', 'C2', 'C3'])""", "d_pred"))
def p07(spark, sf_dir):
    p = tb.d_pred(tb.tables(spark, sf_dir).documents)
    return p.where(fl.any_code_of_interest(F.col("codes"), ["C1", "C2", "C3"])).select("source", "k", "codes")


_P08_INPUT = """
select source, k, case k % 3 when 0 then ['= 1.0 bool'] when 1 then cast([] as varchar[])
                  else list_concat(found, ['= 0.0 bool']) end found
from d_pred"""


@query("P08_not_only_boolean", W(f"""
select source, k from ({_P08_INPUT}) t
where coalesce(len(list_filter(found, lambda x: not contains(x, 'bool'))) > 0, false)""", "d_pred"))
def p08(spark, sf_dir):
    p = tb.d_pred(tb.tables(spark, sf_dir).documents)
    found = (F.when(F.col("k") % 3 == 0, F.array(F.lit("= 1.0 bool")))
              .when(F.col("k") % 3 == 1, F.array().cast("array<string>"))
              .otherwise(F.concat(F.col("found"), F.array(F.lit("= 0.0 bool")))))
    return p.select("source", "k", found.alias("found")).where(fl.not_only_boolean(F.col("found"))).select(
        "source", "k")


@query("P09_drop_numeric_or_empty", W("""
select x from (select STR x from d_mrconso union all select CODE from d_mrconso
               union all select case when LAT = 'SPA' then '' else SAB end from d_mrconso) t
where not (x = '' or regexp_matches(x, '^[0-9]+$'))""", "d_mrconso"))
def p09(spark, sf_dir):
    m = tb.d_mrconso(tb.tables(spark, sf_dir).part)
    u = fl.union_all([m.select(F.col("STR").alias("x")), m.select(F.col("CODE").alias("x")),
                      m.select(F.when(F.col("LAT") == "SPA", "").otherwise(F.col("SAB")).alias("x"))])
    return u.where(~fl.numeric_or_empty(F.col("x")))


@query("P10_non_empty_list", W("""
select source, k, list_filter(codes, lambda x: x in ('C1', 'C2', 'C3', 'C4', 'C5')) codes
from d_pred where len(list_filter(codes, lambda x: x in ('C1', 'C2', 'C3', 'C4', 'C5'))) > 0""", "d_pred"))
def p10(spark, sf_dir):
    p = tb.d_pred(tb.tables(spark, sf_dir).documents)
    c = F.filter("codes", lambda x: x.isin("C1", "C2", "C3", "C4", "C5"))
    return p.select("source", "k", c.alias("codes")).where(fl.non_empty(F.col("codes")))


@query("P11_label_combo", W("""
select source, kk from (select source, k // 2 kk, list(label) labels from d_inner group by source, k // 2) t
where list_contains(labels, 'DISO') and list_contains(labels, 'BIO')
  and not list_contains(labels, 'Chemical_and_drugs')""", "d_inner"))
def p11(spark, sf_dir):
    i = tb.d_inner(tb.tables(spark, sf_dir).documents)
    pairs = i.select("source", F.expr("k div 2").alias("kk"), "label")
    return fl.groups_with_labels(pairs, ["source", "kk"], "label", ["DISO", "BIO"], ["Chemical_and_drugs"])


@query("P12_any_substring", W("""
select CUI, len(list_filter(list(SAB), lambda x: contains(x, '#1'))) > 0 has_source from d_mrconso group by CUI""",
                              "d_mrconso"))
def p12(spark, sf_dir):
    m = tb.d_mrconso(tb.tables(spark, sf_dir).part)
    return m.groupBy("CUI").agg(fl.any_row_contains(F.col("SAB"), "#1").alias("has_source"))


@query("P13_filter_expr", """
select doc_id, n_chars from documents where length(text) > 0 and lang = 'fr' and n_chars > 1000""")
def p13(spark, sf_dir):
    d = tb.tables(spark, sf_dir).documents
    return fl.filter_expr(d, "lang = 'fr' and n_chars > 1000", text_col="text").select("doc_id", "n_chars")


@query("P14_drug_mentions", W("""
select source, count(*) n_drugs, list(term order by k) drugs from d_inner
where label = 'Chemical_and_drugs' group by source""", "d_inner"))
def p14(spark, sf_dir):
    return fl.drug_mentions(tb.d_inner(tb.tables(spark, sf_dir).documents))


# -- U01..U04 -----------------------------------------------------------------

@query("U01_union_all", W("""
select source, k, 'key' kind from d_keys union all select source, k, 'inner' from d_inner""",
                          "d_keys", "d_inner"))
def u01(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    return fl.union_all([tb.d_keys(docs).select("source", "k", F.lit("key").alias("kind")),
                         tb.d_inner(docs).select("source", "k", F.lit("inner").alias("kind"))])


@query("U02_union_code_sets", W("""
select source, list_sort(list_distinct(flatten(list(codes)))) codes from d_pred group by source""", "d_pred"))
def u02(spark, sf_dir):
    return fl.union_sets(tb.d_pred(tb.tables(spark, sf_dir).documents), ["source"], "codes", "codes")


@query("U03_sets_meet", W("""
select p.source, p.k, coalesce(list_position(p.codes, split_part(g.annotation, '_', 1)), 0) > 0 hit
from d_pred p join d_gold g on p.source = g.source and p.k = g.k
where g.annotation is not null""", "d_pred", "d_gold"))
def u03(spark, sf_dir):
    docs = tb.tables(spark, sf_dir).documents
    p = tb.d_pred(docs)
    g = tb.d_gold(docs).where(F.col("annotation").isNotNull()).select("source", "k", "annotation")
    j = p.join(g, ["source", "k"])
    return j.select("source", "k", fl.sets_meet(F.col("codes"), F.array(F.split("annotation", "_")[0])).alias("hit"))


@query("U04_set_difference", """
select doc_id from documents where doc_id not in (select doc_id from labels)""")
def u04(spark, sf_dir):
    t = tb.tables(spark, sf_dir)
    return fl.set_difference(t.documents.select("doc_id"), t.labels, ["doc_id"])
