"""The same queries as SQL, for a cross-check by another engine."""

from __future__ import annotations

# --- clip names ----------------------------------------------------------

CORAA = """
select 'data/train/CORAA_SER/' || lang || '/clip_' || doc_id || '_' ||
       case lang when 'en' then 'neutral' when 'fr' then 'non-neutral-female'
                 else 'non-neutral-male' end || '.wav' as wav_file
from documents"""

BAVED = """
select 'data/train/BAVED/' || event_type || '/' || user_id || '-' ||
       case when user_id % 7 < 3 then 'm' when user_id % 7 < 6 then 'f' else 'x' end ||
       '-21-' || event_id % 5 || '-' || event_id % 3 || '-' || event_id || '.wav' as wav_file
from events"""

EMOVO = """
select 'data/train/EMOVO/' || event_type || '/' ||
       ['neu','dis','gio','pau','rab','sor','tri'][event_id % 7 + 1] || '-' ||
       case when user_id % 2 = 0 then 'f' else 'm' end || (user_id % 3 + 1) ||
       '-b' || event_id || '.wav' as wav_file
from events"""

RAVDESS = """
select 'data/train/RAVDESS/e' || event_id || '/03-01-0' || (event_id % 8 + 1) || '-01-02-01-' ||
       lpad((user_id % 24 + 1)::varchar, 2, '0') || '.wav' as wav_file
from events"""


def _label(gender: str, emotion: str, source: str) -> str:
    return f"""
select wav_file, gender, emotion,
       case when emotion = 'neutral' then 'neutral' else emotion || '-' || gender end as label
from (select wav_file, {gender} as gender,
             case when {emotion} then 'neutral' else 'non-neutral' end as emotion
      from (select wav_file, string_split(string_split(wav_file, '/')[-1], '-') as p
            from ({source})))"""


LABEL_CORAA = f"""
select wav_file, string_split(replace(wav_file, '.wav', ''), '_')[-1] as label from ({CORAA})"""
LABEL_BAVED = _label("case p[2] when 'm' then 'male' when 'f' then 'female' else p[2] end",
                     "p[5] = '1'", BAVED)
BAVED_CUT = f"""
select case when wav_file like '%/error/%'
            then array_to_string(string_split(wav_file, '-')[1:3], '-') || '.wav'
            else wav_file end as wav_file from ({BAVED})"""
LABEL_BAVED_CUT = _label("case p[2] when 'm' then 'male' when 'f' then 'female' else p[2] end",
                         "p[5] = '1'", BAVED_CUT)
LABEL_EMOVO = _label("case when p[2] like 'm%' then 'male' when p[2] like 'f%' then 'female' "
                     "else p[2] end", "p[1] = 'neu'", EMOVO)
LABEL_RAVDESS = _label("case when string_split(p[-1], '.')[1]::int % 2 = 0 then 'female' "
                       "else 'male' end", "p[3] = '01'", RAVDESS)

UNION = f"""
select 'CORAA_SER' as corpus, wav_file, label from ({LABEL_CORAA})
union all select 'BAVED', wav_file, label from ({LABEL_BAVED})
union all select 'EMOVO', wav_file, label from ({LABEL_EMOVO})
union all select 'RAVDESS', wav_file, label from ({LABEL_RAVDESS})"""

DIALOGS = """
select *, 'Ses0' || s || case when user_id % 2 = 0 then 'F' else 'M' end || '_impro' ||
       lpad((user_id % 30)::varchar, 2, '0') as dialog,
       case when user_id % 3 = 0 then 'F' else 'M' end as speaker,
       case event_type when 'click' then 'neu' when 'view' then 'hap' when 'purchase' then 'exc'
                       when 'signup' then 'sad' when 'error' then 'xxx' end as emotion_raw
from (select *, event_id % 5 + 1 as s from events)"""


def _label_dialogs(usable: str) -> str:
    return f"""
select wav_file, gender, emotion,
       case when emotion = 'neutral' then 'neutral' else emotion || '-' || gender end as label
from (select 'data/IEMOCAP/Session' || s || '/sentences/wav/' || dialog || '/' || dialog || '_' ||
             speaker || event_id || '.wav' as wav_file,
             case speaker when 'F' then 'female' else 'male' end as gender,
             case when emotion_raw = 'neu' then 'neutral' else 'non-neutral' end as emotion
      from ({DIALOGS}) where emotion_raw <> 'xxx' and {usable})"""


# --- stratified split ----------------------------------------------------

def _split(source: str, label: str, key: str, columns: str) -> str:
    return f"""
with rows as (select *, {label} as __l, {key} as __k, md5('42:' || {key}) as __h from ({source})),
counts as (select __l, count(*) as c from rows group by 1),
shares as (select __l, c, sum(c) over () as n, ceil(sum(c) over () * 0.2::double)::bigint as d
           from counts),
parts as (select *, (c * d) // n as whole, (c * d) % n as rest from shares),
quotas as (select __l, whole + case when row_number() over (order by rest desc, __l)
                  <= d - sum(whole) over () then 1 else 0 end as quota from parts),
ranked as (select *, row_number() over (partition by __l order by __h, __k) as r from rows)
select {columns}, case when r <= quota then 'dev' else 'train' end as split
from ranked join quotas using (__l)"""


SPLIT_LANG = _split("select doc_id, lang, text from documents", "lang", "doc_id", "doc_id, lang")
LINES = """
select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as clip,
       concat_ws('-', l_returnflag, l_linestatus) as label from lineitem"""
METADATA = f"""
select 'CORAA_SER' as corpus, wav_file, label, split
from ({_split(LABEL_CORAA, "label", "wav_file", "wav_file, label")})
union all select corpus, wav_file, label, 'train' from ({UNION}) where corpus <> 'CORAA_SER'"""


# --- WAV files made of document texts ------------------------------------

FORMATS = """
select doc_id, lang, octet_length(encode(text)) as nbytes, text,
       case lang when 'fr' then 22050 when 'de' then 8000 else 16000 end as rate,
       case lang when 'de' then 2 else 1 end as ch,
       case lang when 'fr' then 8 when 'es' then 24 else 16 end as bits
from documents"""
HEADERS = f"""
select doc_id, lang, nbytes, rate, ch, bits, nbytes // (ch * bits // 8) as frames, text
from ({FORMATS})"""
# one row per sample: (doc_id, i, v), channels interleaved
SAMPLES = f"""
heads as materialized ({HEADERS}),
bytes as (
  select doc_id, ch, bits, frames, unnest(h) as b, generate_subscripts(h, 1) - 1 as j
  from (select *, regexp_extract_all(hex(encode(text)), '..') as h from heads)),
raw as (
  select doc_id, bits, j // (bits // 8) as i,
         sum(('0x' || b)::bigint * (1::bigint << (8 * (j % (bits // 8))))::bigint)::bigint as u
  from bytes where j < frames * ch * (bits // 8) group by 1, 2, 3),
pcm as materialized (
  select doc_id, i, case when bits = 8 then u - 128
                         when u >= (1::bigint << (bits - 1)) then u - (1::bigint << bits)
                         else u end as v
  from raw)"""
ERROR = "case when frames = 0 then 'no samples' end"
LEVELS = f"""
{SAMPLES},
levels as (
  select h.doc_id, lang, nbytes, frames, rate, bits, {ERROR} as error,
         case when l.rms = 0 then '-inf'::double
              else 20 * log10(l.rms / (1::bigint << (bits - 1))) end as dbfs
  from heads h left join (
    select doc_id, floor(sqrt(sum((v * v)::double) / count(*))) as rms from pcm group by 1
  ) l using (doc_id))"""

# mono clips as floats: (doc_id, m, x)
MONO = f"""
{SAMPLES},
mono as materialized (
  select doc_id, i // ch as m, (avg(v / (1::bigint << (bits - 1))::double))::float as x
  from pcm join heads using (doc_id) group by 1, 2)"""

# integer mono, level, gain to the target, as floats
GAIN = f"""
{SAMPLES},
imono as (
  select doc_id, i // ch as m, floor(sum(v) / any_value(ch))::bigint as v, any_value(bits) as bits
  from pcm join heads using (doc_id) group by 1, 2),
rms as (
  select doc_id, floor(sqrt(sum((v * v)::double) / count(*))) as rms, any_value(bits) as bits
  from imono group by 1),
factors as (
  select doc_id, rms, pow(10.0::double, (-31.187887972911266::double
         - 20 * log10(rms / (1::bigint << (bits - 1)))) / 20) as f
  from rms where rms > 0),
gained as materialized (
  select doc_id, m, (greatest(-(1::bigint << (bits - 1)), least((1::bigint << (bits - 1)) - 1,
         floor(v * f))) / (1::bigint << (bits - 1))::double)::float as x
  from imono join factors using (doc_id))"""


def _resampled(source: str, key: str, heads: str) -> str:
    """CTEs: ``source(key, m, x)`` and ``heads(key, rate, frames)`` -> ``resampled(key, m, x)``.

    Every output adds the inputs within six zero crossings of a windowed sinc.
    """
    return f"""
rates as (
  select distinct rate, rate // gcd(rate, 16000) as o, 16000 // gcd(rate, 16000) as n,
         0.99::double * least(rate // gcd(rate, 16000), 16000 // gcd(rate, 16000)) as b
  from {heads} where rate <> 16000),
outputs as (
  select {key}, o, n, b, unnest(range((frames * n + o - 1) // o)) as m
  from {heads} join rates using (rate) where frames > 0),
taps as (
  select {key}, o, n, b, m, unnest(range(
           greatest(0, floor(m * o / n::double - 6 * o / b)::bigint),
           ceil(m * o / n::double + 6 * o / b)::bigint + 1)) as j
  from outputs),
terms as (
  select t.{key}, t.m, t.o, t.b, s.x, (t.j / t.o::double - t.m / t.n::double) * t.b as u
  from taps t join {source} s on s.{key} = t.{key} and s.m = t.j),
resampled as materialized (
  select {key}, m, (sum(case when abs(u) >= 6 then 0 else
           x * case when u = 0 then 1 else sin(pi() * u) / (pi() * u) end
             * pow(cos(pi() * u / 12), 2) end * any_b / any_o))::float as x
  from (select *, b as any_b, o as any_o from terms) group by 1, 2
  union all
  select {key}, m, x from {source} join {heads} using ({key}) where rate = 16000)"""


def _batches(source: str, size: int, error: str) -> str:
    """CTEs with ``lengths(doc_id, n, error, row)`` made from the headers."""
    return f"""
lengths as (
  select doc_id, lang, (frames * 16000 + rate - 1) // rate as n, {error} as error,
         row_number() over (order by doc_id) - 1 as r from {source}),
placed as (
  select *, (r // {size})::bigint as batch_id, (r % {size})::int as pos,
         max(case when error is null then n end) over (partition by r // {size}) as longest
  from lengths)"""


STANDARD = """
moments as (
  select doc_id, avg(x::double) as mu, count(*) as n from resampled group by 1),
spread as (
  select r.doc_id, any_value(mu) as mu, avg((x - mu) * (x - mu)) as var
  from resampled r join moments using (doc_id) group by 1),
absolute as (
  select r.doc_id, sum(abs(((x::double - mu) / sqrt(var + 1e-7))::float::double)) as total
  from resampled r join spread using (doc_id) group by 1)"""

PREPROCESS_TRAIN = f"""
with {MONO}, {_resampled("mono", "doc_id", "heads")}, {_batches("heads", 4, ERROR)}, {STANDARD},
ids as (select lang, (row_number() over (order by lang) - 1)::int as label_id
        from (select distinct lang from documents))
select batch_id, pos, doc_id, label_id,
       case when error is null then n end::int as n_valid,
       case when error is null then longest end::int as padded,
       case when error is null then n end::int as mask,
       round(total / n, 4) as absolute, error
from placed join ids using (lang) left join absolute using (doc_id)"""

PREPROCESS_TEST = f"""
with {GAIN}, {_resampled("gained", "doc_id", "heads")},
measured as (
  select h.*, case when frames = 0 then 'no samples'
                   when f.doc_id is null then 'silent clip has no gain' end as problem
  from heads h left join factors f using (doc_id)),
{_batches("measured", 2, "problem")}, {STANDARD}
select batch_id, pos, doc_id,
       case when error is null then n end::int as n_valid,
       case when error is null then greatest(n, 4032) end::int as padded,
       case when error is null then n end::int as mask,
       round(total / n, 4) as absolute, error
from placed left join absolute using (doc_id)"""

STACKED = f"""
with {MONO}, {_resampled("mono", "doc_id", "heads")}, {_batches("heads", 4, ERROR)},
ids as (select lang, (row_number() over (order by lang) - 1)::int as label_id
        from (select distinct lang from documents))
select batch_id, count(*)::int as size, max(longest)::int as width, sum(n)::bigint as valid,
       array_to_string(list(label_id order by pos), ',') as labels,
       array_to_string(list(doc_id order by pos), ',') as clips
from placed join ids using (lang) where error is null group by 1"""

# the stand-in network scores the sums over every third standardised sample
SCORED = f"""
with {MONO}, {_resampled("mono", "doc_id", "heads")}, {STANDARD},
logits as (
  select r.doc_id, m % 3 as c,
         sum(((x::double - mu) / sqrt(var + 1e-7))::float::double) / any_value(s.n) as z
  from resampled r join spread using (doc_id)
       join (select doc_id, count(*) as n from resampled group by 1) s using (doc_id)
  group by 1, 2),
three as (
  select h.doc_id, t.c, coalesce(l.z, 0) as z from heads h cross join range(3) t(c)
  left join logits l on l.doc_id = h.doc_id and l.c = t.c where frames > 0)
select doc_id, min(case when z = top then c end)::int as label_id,
       round(1 / sum(exp(z - top)), 5) as score
from (select *, max(z) over (partition by doc_id) as top from three) group by 1"""


# --- small pieces --------------------------------------------------------

def _durations(source: str, value: str, keys: str = "") -> str:
    group = f"group by {keys}" if keys else ""
    return f"""
select {keys + ',' if keys else ''} count({value}) as n, round(min({value}), 9) as min_s,
       round(max({value}), 9) as max_s, round(avg({value}), 9) as mean_s,
       round(median({value}), 9) as median_s, round(stddev_pop({value}), 9) as std_s,
       round(sum({value}) / 60, 9) as total_minutes
from ({source}) {group}"""


CLASS_PREDICTIONS = """
select vec_id, label, (list_position(z, list_max(z)) - 1)::int as pred
from (select vec_id, label, list_transform(range(10), lambda c: list_sum(list_transform(
        range(64 // 10 + case when c < 64 % 10 then 1 else 0 end),
        lambda k: embedding[(c + 10 * k + 1)::int]::double))) as z from embeddings)"""


def _class_scores(source: str, truth: str, pred: str) -> str:
    return f"""
select class, sum(tp)::bigint as tp, sum(s)::bigint as support, sum(p)::bigint as predicted,
       2.0::double * sum(tp) / (sum(s) + sum(p)) as f1
from (select {truth} as class, case when {truth} = {pred} then 1 else 0 end as tp, 1 as s, 0 as p
      from ({source})
      union all select {pred}, 0, 0, 1 from ({source}))
group by class"""


def _macro_f1(source: str, truth: str, pred: str) -> str:
    return f"""
select round(avg(f1), 8) as macro_f1, count(*) as n_classes, sum(support)::bigint as n_rows
from ({_class_scores(source, truth, pred)})"""


def _mixed(source: str, name: str) -> str:
    """CTE ``name``: the 32-bit finaliser applied to columns ``a`` and ``b`` of ``source``."""
    def step(column: str, shift: int, factor: int) -> str:
        folded = f"xor({column}::bigint, {column}::bigint >> {shift})::hugeint"
        return f"{folded} * {factor} % 4294967296 as {column}"

    def both(shift: int, factor: int) -> str:
        return f"select * replace ({step('a', shift, factor)}, {step('b', shift, factor)})"

    return (f"{name} as ({both(16, 1)} from ({both(13, 3266489909)} from "
            f"({both(16, 2246822507)} from {source})))")


HISTORY = """
select event_type as run, datediff('day', date '2024-01-01', ts::date)::int as epoch,
       round(avg(value), 6) as value
from events group by 1, 2"""

STAND_IN_MODEL = """
select vec_id, list_transform(range(10), lambda c: list_sum(list_transform(
         range(64 // 10 + case when c < 64 % 10 then 1 else 0 end),
         lambda k: embedding[(c + 10 * k + 1)::int]::double))) as z from embeddings"""

DURATIONS = _durations(f"select frames / rate::double as s from ({HEADERS})", "s")

ORACLES = {
    "label_coraa": LABEL_CORAA,
    "label_baved": LABEL_BAVED,
    "label_emovo": LABEL_EMOVO,
    "label_ravdess": LABEL_RAVDESS,
    "label_quarantine": f"""
select wav_file, case when event_type <> 'error' then gender end as gender,
       case when event_type <> 'error' then emotion end as emotion,
       case when event_type <> 'error' then label end as label
from (select *, string_split(wav_file, '/')[4] as event_type from ({LABEL_BAVED_CUT}))""",
    "annotation_turns": f"""
select 'Session' || s as session, dialog, dialog || '_' || speaker || event_id as turn, emotion_raw
from ({DIALOGS})""",
    "label_iemocap": _label_dialogs("value <= 15.0"),
    "annotated_corpus": _label_dialogs("floor(value * 16000) <= 240000"),
    "annotation_missing": """
select doc_id from documents d
where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
    "union_corpora": UNION,
    "union_counts": f"select corpus, count(*) as n from ({UNION}) group by 1",
    "build_metadata": METADATA,
    "build_metadata_files": f"""
select split as side, 'CORAA_SER' as corpus, label, count(*) as n
from ({_split(LABEL_CORAA, "label", "wav_file", "wav_file, label")}) group by 1, 2, 3
union all
select case when lang = 'fr' then 'rejects' else 'train' end, 'BAVED',
       case when lang = 'fr' then null when doc_id % 3 = 1 then 'neutral'
            else 'non-neutral-male' end, count(*) from documents group by 1, 2, 3""",
    "class_counts": f"select corpus, label, count(*) as n from ({UNION}) group by 1, 2",
    "path_join": """
select page_id, p as no_base, 'data/test/' || p as plain, 'data/test/' || p as slash,
       '/' || p as absolute
from (select page_id, string_split(url, '://')[-1] as p from pages)""",
    "basename": """
select page_id, string_split(url, '/')[-1] as base, string_split(url, '/')[-2] as parent
from pages""",
    "name_collisions": """
select string_split(url, '/')[-1] as name, count(*) as n from pages group by 1 having count(*) > 1""",
    "stratified_split_by_lang": SPLIT_LANG,
    "stratified_split_scale": _split(LINES, "label", "clip", "clip, label"),
    "dev_clips": f"""
select split, lang, count(*) as n, sum(44 + octet_length(encode(text)))::bigint as bytes
from ({SPLIT_LANG.replace("select doc_id, lang, case", "select doc_id, lang, text, case")})
group by 1, 2""",
    "label_dictionary": """
select 'lang' as source, lang as label, (row_number() over (order by lang) - 1)::int as label_id
from (select distinct lang from documents)
union all
select 'event_type', event_type, (row_number() over (order by event_type) - 1)::int
from (select distinct event_type from events)""",
    "label_encode": """
with ids as (
  select source, (row_number() over (order by source) - 1)::int as label_id
  from (select distinct source from documents where doc_id in (select doc_id from labels)))
select doc_id, source, label_id,
       case when label_id is null then 'unknown label' end as label_error
from (select doc_id, source from documents
      union all select -1 - event_id, event_type from events) left join ids using (source)""",
    "label_decode": """
with ids as (select lang, (row_number() over (order by lang) - 1)::int as label_id
             from (select distinct lang from documents))
select doc_id, label_id, lang from documents join ids using (lang)""",
    "duration_stats": _durations("select * from events", "value"),
    "duration_stats_by_type": _durations("select * from events", "value", "event_type"),
    "clip_duration_stats": _durations(
        f"select lang, frames / rate::double as s from ({HEADERS})", "s", "lang"),
    "wav_header": f"""
select doc_id, frames as num_frames, rate::int as sample_rate, ch::int as num_channels,
       bits::int as bits, null::varchar as error from ({HEADERS})""",
    "wav_header_files": f"""
select doc_id, frames as num_frames, rate::int as sample_rate, ch::int as num_channels,
       bits::int as bits, null::varchar as error from ({HEADERS})""",
    "dataset_stats_job": " union all ".join(
        f"select *, '{form}' as form from ({DURATIONS})" for form in ("folder", "table")),
    "mean_dbfs_job": f"""
with {LEVELS}
select form, round(avg(dbfs), 6) as mean_dbfs, count(dbfs) as n_clips, count(error) as n_rejected
from (select *, unnest(['folder', 'table']) as form from levels) group by 1""",
    "predict_job": f"select doc_id, coalesce({ERROR}, 'label') as outcome from ({HEADERS})",
    "fit_evaluate": f"""
select (select count(distinct label) from embeddings) as n_classes, count(*) as n_rows,
       true as is_share
from ({_split("select vec_id, label from embeddings", "label", "vec_id", "vec_id")})
where split = 'dev'""",
    "odd_clips": f"""
with {LEVELS},
kinds as (
  select doc_id * 4 as clip_id, case when frames = 0 then 'no samples' when dbfs = '-inf'::double
         then 'silent clip has no gain' end as error, (frames * 16000 + rate - 1) // rate as n
  from levels
  union all select doc_id * 4 + 1, case when nbytes < 2 then 'no samples'
                                        else 'silent clip has no gain' end, null from levels
  union all select doc_id * 4 + 2, 'no samples', null from levels
  union all select doc_id * 4 + 3, 'not a RIFF/WAVE file', null from levels)
select clip_id, r // 4 as batch_id, (r % 4)::int as pos,
       case when error is null then n::int end as n_valid, error
from (select *, row_number() over (order by clip_id) - 1 as r from kinds)""",
    "feature_vector": f"""
with {MONO}, {_resampled("mono", "doc_id", "heads")},
steps as (select *, lag(x) over (partition by doc_id order by m) as before from resampled),
sums as (
  select doc_id, sqrt(avg(x::double * x::double)) as rms, max(abs(x::double)) as peak,
         coalesce(avg(case when before is not null
                      then ((x < 0) <> (before < 0))::int::double end), 0) as crossings
  from steps group by 1)
select doc_id, case when frames > 0 then 46 end as n, case when frames > 0 then 46 end as n_finite,
       round(rms, 5) as rms, round(peak, 5) as peak,
       round(20 * log10(greatest(rms, 1e-10)), 4) as level, round(crossings, 6) as crossings,
       {ERROR} as error
from heads left join sums using (doc_id)""",
    "pitch_shift": f"""
select doc_id, frames::int as n, case when frames >= 4096 then
         ('0x' || md5('42:0:pitch_shift:' || doc_id)[1:8])::bigint / 4294967296.0::double < 0.5
       end as is_shifted, true as energy_kept
from ({HEADERS}) where frames > 0""",
    "distinct_formats": f"""
select 'sample_rate' as attribute, rate::bigint as value, count(*) as n_clips
from ({HEADERS}) group by 2
union all select 'num_channels', ch::bigint, count(*) from ({HEADERS}) group by 2""",
    "header_audit": f"""
select count(*) as n, count(case when rate <> 16000 then 1 end) as wrong_rate,
       count(case when ch <> 1 then 1 end) as wrong_channels,
       count(case when frames <= 10 then 1 end) as too_short, 0::bigint as no_header
from ({HEADERS})""",
    "clip_dbfs": f"with {LEVELS} select doc_id, round(dbfs, 6) as dbfs, error from levels",
    "mean_dbfs": f"""
with {LEVELS}
select lang, round(avg(dbfs), 6) as mean_dbfs, count(dbfs) as n_clips from levels group by 1""",
    "sample_dbfs": """
select user_id, n as num_samples,
       round(case when rms = 0 then '-inf'::double else 20 * log10(rms / 32768) end, 6) as dbfs
from (select user_id, count(v) as n, floor(sqrt(sum(v * v) / count(v))) as rms
      from (select user_id, greatest(-32768.0, least(32767.0, round((value - 245) * 100)))::double
              as v from events) group by 1)""",
    "wav_decode": f"""
with {SAMPLES}
select h.doc_id, case when frames > 0 then rate::int end as sample_rate,
       case when frames > 0 then ch::int end as num_channels,
       case when frames > 0 then frames end as num_frames,
       round(first_sum, 6) as first_sum, round(last_sum, 6) as last_sum, {ERROR} as error
from heads h left join (
  select doc_id,
         sum(case when i % ch = 0 then v / (1::bigint << (bits - 1))::double end) as first_sum,
         sum(case when i % ch = ch - 1 then v / (1::bigint << (bits - 1))::double end) as last_sum
  from pcm join heads using (doc_id) group by 1) using (doc_id)""",
    "pcm_decode": f"""
with {SAMPLES}
select h.doc_id, case when frames > 0 then frames end as num_frames, lowest, highest, total,
       {ERROR} as error
from heads h left join (
  select doc_id, min(v)::int as lowest, max(v)::int as highest, sum(v)::bigint as total
  from pcm group by 1) using (doc_id)""",
    "rejected_clips": f"""
select kind, outcome, count(*) as n from (
  select 'wav' as kind, coalesce({ERROR}, 'ok') as outcome from ({HEADERS})
  union all select 'page', 'not a RIFF/WAVE file' from pages)
group by 1, 2""",
    "gain_normalise": f"""
with {GAIN}
select h.doc_id, n::int as n, round(total, 6) as total, round(lowest, 6) as lowest,
       round(highest, 6) as highest,
       case when frames = 0 then 'no samples'
            when f.doc_id is null then 'silent clip has no gain' end as error
from heads h left join factors f using (doc_id) left join (
  select doc_id, count(*) as n, sum(x::double) as total, min(x)::double as lowest,
         max(x)::double as highest from gained group by 1) using (doc_id)""",
    "mono_mix": f"""
with {MONO}
select h.doc_id, n::int as n, round(total, 6) as total, round(energy, 4) as energy,
       {ERROR} as error
from heads h left join (
  select doc_id, count(*) as n, sum(x::double) as total, sum(x::double * x::double) as energy
  from mono group by 1) using (doc_id)""",
    "resample": f"""
with vecs as (select vec_id, 22050 as rate, len(embedding) as frames from embeddings),
waves as (select vec_id, unnest(embedding)::double as x,
                 generate_subscripts(embedding, 1) - 1 as m from embeddings),
{_resampled("waves", "vec_id", "vecs")}
select vec_id, count(*)::int as n, round(sum(x::double), 4) as total,
       round(max(x)::double, 4) as highest from resampled group by 1""",
    "standardise": """
with waves as (select vec_id, unnest(embedding)::double as x,
                      generate_subscripts(embedding, 1) as m, len(embedding) as n from embeddings),
means as (select vec_id, avg(x) as mu from waves group by 1),
spread as (select w.vec_id, any_value(mu) as mu, avg((x - mu) * (x - mu)) as var
           from waves w join means using (vec_id) group by 1),
z as (select w.vec_id, m, n, ((x - mu) / sqrt(var + 1e-7))::float::double as z
      from waves w join spread using (vec_id))
select vec_id, round(max(case when m = 1 then z end), 5) as first,
       round(max(case when m = n then z end), 5) as last, round(sum(abs(z)), 4) as absolute
from z group by 1""",
    "noise_augment": f"""
with digests as (select *, md5('42:0:gaussian:' || vec_id) as h from embeddings),
drawn as (
  select vec_id, embedding, ('0x' || h[1:8])::bigint / 4294967296.0::double < 0.25 as hit,
         0.0001::double + (0.001::double - 0.0001::double)
           * (('0x' || h[9:16])::bigint / 4294967296.0::double) as amplitude,
         ('0x' || h[17:24])::hugeint as high, ('0x' || h[25:32])::hugeint as low from digests),
waves as (select vec_id, hit, amplitude, high, low, unnest(embedding)::double as x,
                 (generate_subscripts(embedding, 1) - 1)::hugeint as i from drawn),
started as (select *, (high + 2 * i * 2654435769) % 4294967296 as a,
                   (high + (2 * i + 1) * 2654435769) % 4294967296 as b from waves),
{_mixed("started", "once")},
keyed as (select * replace ((a + low) % 4294967296 as a, (b + low) % 4294967296 as b) from once),
{_mixed("keyed", "twice")},
uniforms as (select *, (a + 0.5::double) / 4294967296.0::double as u1,
                    (b + 0.5::double) / 4294967296.0::double as u2 from twice),
noisy as (
  select vec_id, case when hit then (x + amplitude * sqrt(-2 * ln(u1)) * cos(2 * pi() * u2))::float
                      else x::float end::double as y from uniforms)
select vec_id, round(sum(y), 5) as total, round(sum(abs(y)), 5) as absolute from noisy group by 1""",
    "pad_batch": f"""
with heads as ({HEADERS}), {_batches("heads", 4, ERROR)}
select doc_id, batch_id, pos,
       greatest((longest + 7) // 8 * 8, case when error is null then n end)::int as pad_to, error
from placed""",
    "preprocess_train": PREPROCESS_TRAIN,
    "augment_none": PREPROCESS_TRAIN,
    "tone_features": """
select s_suppkey::bigint as s_suppkey, round(0.5 / sqrt(2), 4) as rms,
       (16 + s_suppkey % 48)::double as centroid,
       (17 + s_suppkey % 48) * 31.25::double as roll_off, null::varchar as error from supplier""",
    "shifted_tones": """
select s_suppkey::bigint as s_suppkey, 8192 as n, true as is_moved, true as is_kept from supplier""",
    "preprocess_test": PREPROCESS_TEST,
    "stacked_batches": STACKED,
    "preprocess_files": STACKED,
    "score_batches": SCORED,
    "softmax_scores": """
select vec_id, round(list_max(p) / list_sum(p), 8) as top,
       round(list_sum(list_transform(p, lambda v: v / t)), 8) as total, len(p)::int as n
from (select vec_id, p, list_sum(p) as t from (
  select vec_id, list_transform(embedding, lambda v: exp(v::double - list_max(embedding)::double))
    as p from embeddings))""",
    "argmax_predict": CLASS_PREDICTIONS,
    "macro_f1": _macro_f1(CLASS_PREDICTIONS, "label", "pred"),
    "class_scores": f"""
select class, tp, support, predicted, round(f1, 8) as f1
from ({_class_scores(CLASS_PREDICTIONS, "label", "pred")})""",
    "binary_f1": _macro_f1("select * from labels", "quality", "toxic"),
    "pred_truth_pairing": """
with p as (
  select doc_id, min(label) as pred, count(*) as n_pred from (
    select doc_id, lang as label from documents
    union all select doc_id, 'toxic' from labels where toxic = 1) group by 1),
t as (
  select doc_id, min(label) as truth, count(*) as n_truth from (
    select doc_id, quality::varchar as label from labels
    union all select -1 - item_id, 'none' from benchmark) group by 1)
select doc_id, pred, truth,
       case when n_pred > 1 or n_truth > 1 then 'duplicate' when n_truth is null then 'only_pred'
            when n_pred is null then 'only_truth' else 'both' end as status
from p full outer join t using (doc_id)""",
    "score_predictions": _macro_f1(CLASS_PREDICTIONS, "label", "pred"),
    "best_epoch": f"""
select run, epoch as best_epoch, value as best_value
from (select *, row_number() over (partition by run order by value desc, epoch) as r
      from ({HISTORY})) where r = 1""",
    "early_stop": f"""
with h as (select *, row_number() over (partition by run order by epoch) as place,
                  max(value) over (partition by run order by epoch
                                   rows between unbounded preceding and 1 preceding) as top
           from ({HISTORY})),
w as (select *, place - max(case when top is null or value > top then place end) over (
             partition by run order by epoch rows unbounded preceding) as waited from h)
select run, min(case when waited >= 5 then epoch end)::int as stop_epoch from w group by 1""",
    "csv_roundtrip": "select * from customer",
    "text_csv_roundtrip": """
select 'a "b", ' || url as wav_file, ' x,' || page_id as label from pages""",
    "wav_roundtrip": f"""
with {LEVELS}
select doc_id, lang, nbytes + 44 as length, round(dbfs, 6) as dbfs, error from levels""",
    "manifest_versions": """
with d as (select doc_id, (doc_id % 4)::varchar as folder,
                  case when doc_id % 5 > 0 then strlen(coalesce(text, '')) else 0 end as n
           from documents where doc_id % 3 <> 2)
select doc_id, folder, n::bigint as length, 'added' as change, (1 + doc_id % 2)::int as version from d
union all
select doc_id, folder, (n + 1)::bigint, 'changed', 3 from d where doc_id % 7 = 0""",
    "load_by_path": f"""
with {LEVELS}
select doc_id, nbytes + 44 as length, round(dbfs, 6) as dbfs, error from levels
union all
select -1 - item_id, null, null, 'cannot read file: FileNotFoundError' from benchmark""",
    "kept_statistics": f"""
select 'durations' as part, count(*) as n, round(min(s), 6) as min_s, round(max(s), 6) as max_s,
       round(avg(s), 6) as mean_s, round(stddev_pop(s), 6) as std_s,
       round(sum(s) / 60, 6) as total_minutes
from (select frames / rate::double as s from ({HEADERS}))
union all
select rate || ' x ' || ch, count(*), null, null, null, null, null from ({HEADERS}) group by 1""",
    "long_clip_levels": f"""
with {LEVELS}
select doc_id, frames as num_frames, rate::int as sample_rate, round(dbfs, 6) as dbfs, error
from levels""",
    "long_clip_waves": f"""
with {MONO},
w as (select doc_id, avg(x::double) as mean, var_pop(x::double) as var from mono group by 1),
p as (select doc_id, lang, frames, rate, 1000 // (bits // 8) as per from heads where lang in ('en', 'es')),
f as (
  select doc_id, m, round(((x - mean) / sqrt(var + 1e-7))::float::double, 3) as v
  from mono join w using (doc_id) join p using (doc_id) where m % per = 0)
select doc_id, m as first_sample, v as value, null::varchar as error from f
union all
select doc_id, null, ceil(frames * 16000 / rate::double), null from heads where frames > 0
union all
select doc_id, null, null, 'no samples' from heads where frames = 0""",
    "ingest_clips": f"""
select doc_id, nbytes + 44 as length, frames as num_frames, rate::int as sample_rate,
       null::varchar as error from ({HEADERS})""",
    "fit_epochs": """
select run, epoch, split, n_rows, n_batches, n_metrics, finite_loss
from (values ('slow'), ('fast')) r(run), (select unnest(range(3))::int as epoch) e,
     (select 'train' as split, count(*) as n_rows, 2 as n_batches, 3::bigint as n_metrics,
             true as finite_loss from embeddings where vec_id % 5 <> 0
      union all
      select 'eval', count(*), null, 2, null from embeddings where vec_id % 5 = 0) s""",
    "fit_one_step": """
with x as (
  select vec_id, label::int as label, d, embedding[d]::double as v
  from embeddings, (select unnest(range(1, 65)) as d)),
m as (select d, avg(v) as mean, stddev_pop(v) as scale from x where vec_id % 5 <> 0 group by 1),
z as (select vec_id, label, d, (v - mean) / case when scale > 0 then scale else 1 end as z
      from x join m using (d)),
c as (select label, d, sum(z) as z from z where vec_id % 5 <> 0 group by 1, 2),
n as (select label, count(*) as n, (select count(*) from embeddings where vec_id % 5 <> 0) as total
      from embeddings where vec_id % 5 <> 0 group by 1),
k as (select unnest(range(0, (select max(label) + 1 from n)))::int as label),
s as (
  select z.vec_id, k.label,
         coalesce(sum(c.z * z.z) / max(n.total), 0) + coalesce(max(n.n)::double / max(n.total), 0) as s
  from z cross join k left join c on c.label = k.label and c.d = z.d left join n on n.label = k.label
  where z.vec_id % 5 = 0 group by 1, 2),
e as (select vec_id, label, exp(s - max(s) over (partition by vec_id)) as e from s)
select vec_id, 'class ' || arg_max(label, e) as label, round(max(e) / sum(e), 6) as score
from e group by 1""",
    "evaluate_stored": _macro_f1("""
select label::int as truth, (list_position(z, list_max(z)) - 1)::int as pred
from (select label, list_transform(range(10), lambda k: list_sum(list_transform(
        range(k + 1, 65, 10), lambda j: embedding[j]::double))) as z from embeddings)""",
                                 "truth", "pred"),
    "batch_predict": f"""
select vec_id, (list_position(z, list_max(z)) - 1)::int as label_id,
       round(1 / list_sum(list_transform(z, lambda v: exp(v - list_max(z)))), 8) as score
from ({STAND_IN_MODEL})""",
}
