"""DuckDB SQL for those queries of the subpackage that SQL can express."""

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _crc_table() -> list[int]:
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return table


def _resampling() -> str:
    table = ", ".join(map(str, _crc_table()))
    words = (
        f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), "
        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )
    # A feature's CRC: its bytes, from the hexadecimal digits, through the table of remainders.
    return f"""
    with table_of as (select [{table}]::bigint[] as crc_table),
    worded as (
      select 'd' as side, doc_id, row_number() over () as row, {words} as w from documents
      union all select 'b', null, 0, {words} from benchmark),
    grams as (
      select side, doc_id, row, len(w) as n_words,
        list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as features from worded),
    single as (select side, row, unnest(features) as feature from grams),
    counted as (select feature, count(*) filter (side = 'd') as s, count(*) filter (side = 'b') as t from single group by feature),
    hashed as (
      select feature, s, t, xor(list_reduce(
          list_prepend(4294967295::bigint, list_transform(range(0, octet_length(encode(feature))),
            lambda i: ('0x' || substring(hex(encode(feature)), (2 * i + 1)::int, 2))::bigint)),
          lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 10000 as bucket
      from counted, table_of),
    buckets as (select bucket, sum(s)::double as s, sum(t)::double as t from hashed group by bucket),
    sums as (select sum(s) as s, sum(t) as t from buckets),
    gains as (
      select bucket, floor(1000 * ln((b.t + 1) * (sums.s + 10000) / ((b.s + 1) * (sums.t + 10000))))::bigint as gain
      from buckets b, sums),
    weights as (
      select row, floor(sum(gain)::hugeint / count(*))::bigint as weight
      from single join hashed using (feature) join gains using (bucket) where side = 'd' group by row),
    scored as (
      select g.doc_id, len(features) as n_features, n_words, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || g.doc_id), 8))::bigint + 0.5) / 4294967296.0::double)))::bigint as score
      from grams g left join weights using (row) where side = 'd'),
    placed as (
      select doc_id, row_number() over (order by score desc, doc_id) as place, 25 * count(*) over () // 100 as quota
      from scored where n_words >= 20)
    select doc_id, n_features, weight, score, case when place <= quota then place end as rank
    from scored left join placed using (doc_id)
    """


COLLOCATIONS = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
worded as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from worded, range(1, 4) sizes(k)),
counted as materialized (select lang, k, phrase, count(*) as a from grams group by lang, k, phrase),
totals as (select lang, sum(a)::bigint as n from counted where k = 1 group by lang),
frequent as materialized (select lang, k, phrase, a from counted where a >= 10),
candidates as materialized (select lang, k, phrase, string_split(phrase, ' ') as w, a from frequent where k > 1),
halves as materialized (
  select lang, phrase, a, cut, array_to_string(w[1:cut], ' ') as first_part, array_to_string(w[cut + 1:], ' ') as rest
  from (select *, unnest(range(1, k)) as cut from candidates)),
cuts as (
  select h.lang, h.phrase, h.a, cut, l.a as l, r.a as r,
    (1000000::hugeint * h.a * h.a) // (l.a::hugeint * r.a::hugeint) as score
  from halves h
  join frequent l on l.lang = h.lang and l.phrase = h.first_part
  join frequent r on r.lang = h.lang and r.phrase = h.rest),
weakest as (
  select *, row_number() over (partition by lang, phrase order by score, cut) as place from cuts),
inner_phrases as (
  select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase, a as longer
  from candidates where k = 3),
absorbed as (
  select distinct c.lang, c.phrase from candidates c join inner_phrases using (lang, phrase) where 100 * longer >= 50 * c.a),
ranked as (
  select w.*, row_number() over (partition by w.lang order by score desc, a desc, phrase) as rank
  from weakest w anti join absorbed using (lang, phrase) where place = 1)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000
"""

# The given pages mark their article, so there SQL can cut it out; html_text makes no such assumption.
HTML_TEXT = r"""
with articles as (
  select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) as inside from pages),
plain as (
  select page_id, url, regexp_replace(regexp_replace(inside, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') as t from articles),
decoded as (
  select page_id, url, regexp_replace(regexp_replace(t, '&quot;?', '"', 'g'), '&amp;?', '&', 'g') as t from plain),
joined as (select page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) as text from decoded)
select page_id, url, text, length(text) as n_chars from joined
"""

ORACLE: dict[str, str] = {
    "op11_importance_resampling": _resampling(),
    "op12_collocations": COLLOCATIONS,
    "op13_html_text": HTML_TEXT,
}
