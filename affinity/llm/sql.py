"""SQL counterparts (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from affinity.llm import license_scan, quality_rules

UPPER, LOWER = license_scan.UPPER, license_scan.LOWER

SUFFIX_DEDUP = """with b as materialized (select doc_id, encode(coalesce(text, '')) t from documents),
  l as (select doc_id, t, octet_length(t)::bigint n from b),
  w as materialized (select doc_id, i, t[i+1:i+100] win
    from (select doc_id, t, unnest(range(0, n-99)) i from l)),
  f as (select win, min({'d': doc_id, 'i': i}) f from w group by 1 having count(*) > 1),
  late as (select doc_id, w.i from w join f using (win) where f.f.d <> doc_id or f.f.i <> w.i),
  runs as (select *, sum(new) over (partition by doc_id order by i) run from (select *,
    case when i <= lag(i) over (partition by doc_id order by i) + 100 then 0 else 1 end new from late)),
  spans as materialized (select doc_id, run, min(i) a, max(i)+100 z from runs group by 1, 2),
  parts as (select doc_id, coalesce(lag(z) over (partition by doc_id order by a), 0) a, a z from spans
    union all
    select doc_id, coalesce(max(z), 0) a, any_value(n) z from l left join spans using (doc_id) group by 1),
  kept as (select doc_id, sha256(unhex(string_agg(hex(t[a+1:z]), '' order by a))) kept_sha256
    from parts join b using (doc_id) group by 1)
  select doc_id, n n_bytes, coalesce(sum(z-a), 0)::bigint n_removed, count(z) n_spans,
    any_value(kept_sha256) kept_sha256
  from l left join spans using (doc_id) join kept using (doc_id) group by doc_id, n"""

JACCARD_JOIN = rf"""with recursive w as (select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws
    from documents),
  s as materialized (select distinct doc_id, unnest(case
    when len(ws) >= 3 then list_transform(range(1, len(ws)-1), lambda i: ws[i]||' '||ws[i+1]||' '||ws[i+2])
    when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) g from w),
  n as materialized (select doc_id, count(*) n from s group by 1),
  p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id
    group by 1, 2),
  e as materialized (select p.a, p.b from p join n x on x.doc_id = a join n y on y.doc_id = b
    where 100*c >= 90*(x.n+y.n-c)),
  r(doc_id, root) as (select doc_id, doc_id from documents union
    select t.b, r.root from r join (select a, b from e union all select b, a from e) t on t.a = r.doc_id)
  select doc_id, coalesce(any_value(n.n), 0)::bigint n_shingles, min(root) component_id
  from r left join n using (doc_id) group by doc_id"""


_WHOLE = """list_transform(embedding, lambda x: floor(256 * x::double)::bigint) v"""
_TAKES_PART = """vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""
_PRODUCT = """coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0)::bigint"""

TOPK_PRODUCTS = f"""with w as materialized (select vec_id, min(v) v
    from (select vec_id, {_WHOLE} from embeddings where {_TAKES_PART}) group by 1),
  s as (select a.vec_id query_id, b.vec_id, {_PRODUCT} score
    from w a join w b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0)
  select query_id, r::integer "rank", vec_id, score
  from (select *, row_number() over (partition by query_id order by score desc, vec_id) r from s) where r <= 5"""

HARD_NEGATIVES = f"""with l as (select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end label,
    {_WHOLE} from embeddings where label is not null and {_TAKES_PART}),
  w as materialized (select vec_id, x.label, x.v from (select vec_id, min({{'label': label, 'v': v}}) x from l group by 1)),
  s as materialized (select a.vec_id anchor_id, b.vec_id, a.label = b.label same, {_PRODUCT} score
    from w a join w b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
  p as (select anchor_id, vec_id positive_id, score positive_score from (select *,
    row_number() over (partition by anchor_id order by score desc, vec_id) r from s where same) where r <= 5),
  n as (select anchor_id, positive_id, vec_id negative_id, positive_score, score negative_score,
    row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) r
    from p join s using (anchor_id) where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score)
  select anchor_id, positive_id, r::integer "rank", negative_id, positive_score, negative_score from n where r <= 10"""


def _license_scan() -> str:
    rows = []
    for t, (label, text) in enumerate(license_scan.TEMPLATES):
        words = license_scan.template_words(text)
        rows += [
            f"({t}, '{label}', {len(words)}, {p}, '{words[p]}', '{words[p+1]}', '{words[p+2]}')"
            for p in range(len(words) - 2)
        ]
    phrases = " union all ".join(
        f"select doc_id, i-1 pos, '{label}' label from x, unnest(range(1, len(ws)+1)) u(i) where "
        + " and ".join(f"ws[i+{k}] = '{w}'" for k, w in enumerate(phrase.split()))
        for phrase, label in license_scan.PHRASES
    )
    return rf"""with x as materialized (select doc_id, regexp_extract_all(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents),
    base as materialized ({phrases}),
    places as (values {', '.join(rows)}),
    votes as (select doc_id, p.* , i-1-t diagonal from x, unnest(range(1, len(ws)-1)) u(i)
      join places p(template, label, length, t, a, b, c) on ws[i] = a and ws[i+1] = b and ws[i+2] = c),
    diagonals as (select doc_id, template, label, length, diagonal, list(distinct t) ts from votes group by all),
    marked as (select *, case when diagonal - lag(diagonal) over v <= {license_scan.MAX_DRIFT} then 0 else 1 end new
      from diagonals window v as (partition by doc_id, template order by diagonal)),
    runs as (select *, sum(new) over (partition by doc_id, template order by diagonal) run from marked),
    notices as (select doc_id, label, length, min(diagonal + list_min(ts)) a, max(diagonal + list_max(ts) + 2) z,
      len(list_distinct(flatten(list_transform(flatten(list(ts)), lambda t: [t, t+1, t+2])))) / length::double cover
      from runs group by doc_id, template, label, length, run),
    found as (select doc_id, label, a, z, cover from notices
      where cover >= {license_scan.MIN_COVER}::double and z - a < 2 * length),
    apart as (select *, case when a <= max(z) over (partition by doc_id, label order by a, z
      rows between unbounded preceding and 1 preceding) then 0 else 1 end new from found),
    b as (select doc_id, count(*) n, min(pos) a, max(pos) z, list(distinct label) ls from base group by 1),
    m as (select doc_id, sum(new)::bigint n, max(cover) cover, list(distinct label) ls from apart group by 1)
    select doc_id, len(ws)::bigint n_words, coalesce(b.n, 0) n_base, b.a first_word, b.z last_word,
      array_to_string(list_sort(coalesce(b.ls, [])), ',') base_labels,
      array_to_string(list_sort(list_distinct(coalesce(b.ls, []) || coalesce(m.ls, []))), ',') labels,
      case when b.n > 0 then 1.0::double else coalesce(cover, 0.0::double) end score,
      coalesce(m.n, 0) n_notices
    from x left join b using (doc_id) left join m using (doc_id)"""


def _quality_rules() -> str:
    q = quality_rules
    steps = max(len(cuts) for cuts in q.GRIDS.values())
    grid = ", ".join(  # the strictest cutoff of a rule belongs to the last step, the one before to the step before
        f"('{rule}', {steps - 1 - n}, {c}::double)" for rule, cuts in q.GRIDS.items() for n, c in enumerate(cuts)
    )
    figures = {
        "symbols_per_word": "n_symbols / greatest(n_words, 1)::double",
        "dup_line_share": "n_dup_lines / greatest(n_lines, 1)::double",
        "repeat_share": "n_repeat_words / greatest(n_words, 1)::double",
        "long_words": "word_chars / greatest(n_words, 1)::double",
        "short_words": "-(word_chars / greatest(n_words, 1)::double)",
    }
    long = " union all ".join(f"select doc_id, st, '{rule}' rule, {v} v from fig" for rule, v in figures.items())
    tail = (
        f"list_sum(list_transform(range(0, k+1), lambda i: exp(lgamma(n+1) - lgamma(i+1) - lgamma(n-i+1) "
        f"+ i*ln({q.RISK}::double) + (n-i)*ln(1-{q.RISK}::double))))"
    )
    return rf"""with w as (select doc_id, coalesce(lang, '(none)') st, coalesce(text, '') t,
      list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') ws,
      list_filter(string_split(coalesce(text, ''), chr(10)),
        lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls from documents),
    g as (select doc_id, i, ws[i]||' '||ws[i+1]||' '||ws[i+2] g
      from (select doc_id, ws, unnest(range(1, len(ws)-1)) i from w)),
    rep as (select doc_id, count(distinct p) r from (select doc_id, unnest([i, i+1, i+2]) p from
      (select doc_id, i, count(*) over (partition by doc_id, g) c from g) where c > 1) group by 1),
    fig as materialized (select *, n_words < 50 or 100*n_repeat_words > 50*n_words base_failed from (select doc_id, st,
      len(ws)::bigint n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint word_chars,
      len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint n_symbols,
      (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines, coalesce(r, 0)::bigint n_repeat_words,
      len(ls) n_lines from w left join rep using (doc_id))),
    long as ({long}),
    good as (select doc_id from labels where doc_id is not null and quality is not null
      group by 1 having min(quality) = 1),
    held as (select fig.doc_id, st from fig join good using (doc_id) where not base_failed),
    n as (select st, count(*) n from held group by 1),
    grid(rule, step, cut) as (values {grid}),
    firsts as materialized (select doc_id, st, min(step) first from long join grid using (rule) where v > cut group by 1, 2),
    lost as (select firsts.* from firsts join held using (doc_id, st)),
    tested as (select n.st, step, any_value(n.n) n, count(lost.doc_id) k from n cross join range({steps}) s(step)
      left join lost on lost.st = n.st and first <= step group by 1, 2),
    failed as (select st, min(step) step from tested
      where k > n * {q.RISK}::double or {tail} > {q.DELTA}::double / greatest(1, (select count(*) from n
        where pow(1-{q.RISK}::double, n) <= {q.DELTA}::double)) group by 1),
    chosen as (select n.st, coalesce(failed.step, {steps}) - 1 step from n left join failed using (st)),
    gone as (select distinct doc_id from firsts join chosen using (st) where first <= step)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      not base_failed and doc_id not in (select doc_id from gone) kept from fig"""


LICENSE_SCAN = _license_scan()
QUALITY_RULES = _quality_rules()
