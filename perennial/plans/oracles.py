"""The same questions as DuckDB SQL, written independently of the Spark jobs."""

from __future__ import annotations

_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "prediction_metrics": (
        (),
        """select event_id, ts, concat('v3_', cast(user_id % 12 as varchar)) as model_version,
 event_type as actual,
 case when event_id % (2 + user_id % 12) = 0 then 'view' else event_type end as predicted,
 case when event_id % 50 = 0 then null
  else (event_id % (2 + user_id % 12) <> 0 or event_type = 'view') end as is_correct,
 abs(value) / 100 as latency,
 cast(event_id % 97 + 1 as double) / cast(98 as double) as confidence from events""",
    ),
    "image_objects": (
        (),
        """select doc_id, version, outcome, class_name,
 concat(version,'/',outcome,'/',class_name,'_',cast(doc_id as varchar),
  case when doc_id % 11 = 0 then '.png' else '.jpg' end) as path
 from (select doc_id, concat('v3_', cast(doc_id % 12 as varchar)) as version,
  case when doc_id % 5 < 2 then 'correct_predictions' else 'incorrect_predictions' end as outcome,
  concat(source,' ',lang) as class_name from documents) t""",
    ),
    "label_objects": (
        ("image_objects",),
        """select i.doc_id,
 concat(i.version,'/',i.outcome,'/',i.class_name,'_',cast(i.doc_id as varchar),'_labels.json') as label_path,
 case when l.toxic = 1 and l.quality = 0 then '{bad'
  when i.doc_id % 13 = 0 then '{"model_label": "x"}'
  else concat('{"model_label": "x", "api_label": "', i.class_name, '"}') end as value
 from image_objects i join labels l on i.doc_id = l.doc_id""",
    ),
    "label_map": (
        (),
        """select class_name, cast(row_number() over (order by class_name) - 1 as int) as label_id
 from (select distinct concat(source,' ',lang) as class_name from documents) t""",
    ),
    "earlier_label_map": (
        (),
        """select class_name, cast(row_number() over (order by class_name) - 1 as int) as label_id
 from (select distinct concat(source,' ',lang) as class_name from documents where lang <> 'fr') t""",
    ),
    "class_distribution": (
        (),
        """select concat('v3_', cast(o_custkey % 12 as varchar)) as model_version,
 o_orderpriority as class_label, cast(substr(o_orderpriority,1,1) as int) - 1 as label_id,
 date_trunc('month', o_orderdate)::timestamp as run_timestamp, count(*) as example_count
 from orders group by 1,2,3,4""",
    ),
    "label_pairs": (
        (),
        """select p_partkey, p_name as actual, case p_partkey % 4
 when 0 then replace(p_name,' ','_')
 when 1 then concat(split_part(p_name,' ',2),'_',split_part(p_name,' ',1))
 when 2 then concat(p_name,' ',p_brand)
 else substr(p_name,1,length(p_name)-1) end as predicted from part""",
    ),
    "scores": (
        (),
        """select vec_id, label, list_transform(e, lambda x: x / list_sum(e)) as scores
 from (select vec_id, label, list_transform(range(0, 10), lambda c: exp(list_sum(list_transform(
   list_filter(embedding, lambda x, i: (i - 1) % 10 = c), lambda x: x::double)))) as e
  from embeddings) t""",
    ),
    "model_metrics": (
        ("prediction_metrics",),
        """select model_version, day as ts, string_agg(e,'|' order by e) as confusion_matrix
 from (select model_version, date_trunc('day', ts)::timestamp as day,
  concat(actual,':',predicted,':',cast(count(*) as varchar)) as e
  from prediction_metrics group by model_version, day, actual, predicted) t group by 1,2""",
    ),
    # Images that training reads: incorrect predictions, .jpg only.
    "wrong_images": (
        ("image_objects",),
        """select path, version, outcome, class_name, doc_id from image_objects
 where outcome = 'incorrect_predictions' and path like '%.jpg'""",
    ),
    "paired": (
        ("wrong_images", "label_objects"),
        """select w.path, l.label_path,
 case when json_valid(l.value) then l.value->>'$.api_label' end as api_label
 from wrong_images w join label_objects l on l.label_path = replace(w.path, '.jpg', '_labels.json')""",
    ),
    "training_examples": (
        ("paired", "earlier_label_map"),
        """select path, split_part(split_part(path,'/',3),'.',1) as filename,
 m.class_name, m.label_id from paired join earlier_label_map m on m.class_name = paired.api_label""",
    ),
    "earlier": (
        ("wrong_images",),
        """select version, path from wrong_images
 where version like 'v3\\_%' escape '\\' and cast(split_part(version,'_',2) as int) < 10""",
    ),
    "replayed": (
        ("earlier",),
        """select version, path from (select version, path,
  row_number() over (partition by version order by md5(concat('42|',path)), path) as rn,
  count(*) over (partition by version) as n from earlier) t
 where rn <= floor(n * 0.2::double)""",
    ),
    "training_files": (
        ("wrong_images", "replayed"),
        """select path, 'current' as origin from wrong_images where version = 'v3_10'
 union all select path, 'replay' as origin from replayed""",
    ),
    "ordered_examples": (
        ("training_examples",),
        """select filename, path, row_number() over (order by md5(concat('42|',path)), path) as position,
 count(*) over () as total from training_examples""",
    ),
    "champion_accuracy": (
        ("prediction_metrics",),
        """select model_version, avg(is_correct::int) as acc from prediction_metrics
 where model_version in ('v3_9','v3_10') group by model_version""",
    ),
    "evaluated": (
        ("champion_accuracy",),
        """select 'v3_9' as champion, 'v3_10' as challenger,
 coalesce((select acc from champion_accuracy where model_version = 'v3_9'), 0.0::double) as champion_score,
 coalesce((select acc from champion_accuracy where model_version = 'v3_10'), 0.0::double) as challenger_score""",
    ),
    "newest": (
        ("class_distribution",),
        """select * from (select *, row_number() over (partition by model_version, class_label
  order by run_timestamp desc, example_count desc) as rn from class_distribution) t where rn = 1""",
    ),
    "pixel_rows": (
        (),
        """select vec_id, list_transform(embedding, lambda x: x::double / 127.5::double - 1.0::double) as px
 from embeddings""",
    ),
    "dims": (
        (),
        """select vec_id, label, unnest(embedding)::double as x,
 generate_subscripts(embedding, 1) as pos from embeddings""",
    ),
    "centers": (
        ("dims",),
        "select label, pos, avg(x) as m from dims group by label, pos",
    ),
    "distances": (
        ("dims", "centers"),
        """select d.vec_id, c.label, sum((d.x - c.m) * (d.x - c.m)) as dist
 from dims d join centers c on c.pos = d.pos group by d.vec_id, c.label""",
    ),
}


def _with(body: str, *views: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _VIEWS[name][0]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        add(view)
    if not ordered:
        return body
    ctes = ",\n".join(f"{name} as ({_VIEWS[name][1]})" for name in ordered)
    # a body may begin with views of its own
    return f"with {ctes}{body}" if body.startswith(",") else f"with {ctes}\n{body}"


# Longest common subsequence: one list per character of a, as a fold.
def _lcs(a: str, b: str) -> str:
    return f"""list_reduce(
 list_concat([list_transform(range(0, length({b}) + 1), lambda z: 0::bigint)],
  list_transform(range(1, length({a}) + 1), lambda i: [i::bigint])),
 lambda prev, cur: list_reduce(
  list_concat([[0::bigint]], list_transform(range(1, length({b}) + 1), lambda j: [j::bigint])),
  lambda acc, j: list_append(acc,
   case when substr({a}, cur[1]::int, 1) = substr({b}, j[1]::int, 1) then prev[j[1]] + 1
    else greatest(prev[j[1] + 1], acc[j[1]]) end)))[-1]"""


def _ratio(a: str, b: str) -> str:
    return f"""case when {a} is null or {b} is null then 0 when {a} = {b} then 100
 when length({a}) = 0 or length({b}) = 0 then 0
 else cast(round_even(200.0::double * {_lcs(a, b)} / (length({a}) + length({b})), 0) as int) end"""


_ALIAS = """case {0} when 'german shepherd' then 'germanshepherd' when 'alaskan malamute' then 'malamute'
 when 'blldog boston' then 'Boston_bull' when 'terrier scottish' then 'Scotch_terrier'
 when 'hound blood' then 'bloodhound' when 'terrier kerryblue' then 'Kerry_blue_terrier' else {0} end"""


def _words(label: str) -> str:
    plain = f"trim(replace(replace(lower({label}), '_', ' '), '-', ' '))"
    found = _ALIAS.format(plain)
    return (
        f"list_sort(list_distinct(list_filter(regexp_split_to_array({found}, '\\s+'), "
        "lambda w: w <> '')))"
    )


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    def add(key: str, body: str, *views: str) -> None:
        sql[key] = _with(body, *views)

    # objects and labels
    add(
        "list_current_version",
        "select path, version, outcome from wrong_images where version = 'v3_10'",
        "wrong_images",
    )
    add(
        "list_by_prefix",
        """select prefix, count(*) as n from image_objects
 join (values ('v3_0/correct_predictions/'), ('v3_0/incorrect_predictions/')) p(prefix)
 on starts_with(path, prefix) where path like '%.jpg' group by prefix""",
        "image_objects",
    )
    add(
        "list_label_files",
        """select label_path from label_objects where label_path like '%\\_labels.json' escape '\\'
 and split_part(label_path,'/',2) in ('correct_predictions','incorrect_predictions')""",
        "label_objects",
    )
    add(
        "list_json_capped",
        """select path from (select case when doc_id % 2 = 0 then upper(label_path) else label_path end as path
 from label_objects) t where lower(path) like '%.json' order by path limit 50""",
        "label_objects",
    )
    add(
        "earlier_versions",
        """select distinct version, cast(split_part(version,'_',2) as int) as minor from image_objects
 where cast(split_part(version,'_',2) as int) < 10""",
        "image_objects",
    )
    add("pair_image_label", "select path, label_path, api_label from paired", "paired")
    sql["pair_stored"] = sql["pair_image_label"]
    add(
        "label_json_parse",
        """select label_path, case when json_valid(value) then value->>'$.model_label' end as model_label,
 case when json_valid(value) then value->>'$.api_label' end as api_label from label_objects""",
        "label_objects",
    )
    add(
        "quarantine_reasons",
        """select reason, count(*) as n from (select case when l.label_path is null then 'missing_label'
  when not json_valid(l.value) then 'bad_json'
  when case when json_valid(l.value) then l.value->>'$.api_label' end is null then 'no_api_label'
  when m.class_name is null then 'unknown_label' end as reason
 from wrong_images w left join label_objects l on l.label_path = replace(w.path,'.jpg','_labels.json')
 left join earlier_label_map m on m.class_name = case when json_valid(l.value) then l.value->>'$.api_label' end) t
 where reason is not null group by reason""",
        "wrong_images",
        "label_objects",
        "earlier_label_map",
    )
    add("label_map_explode", "select class_name, label_id from label_map", "label_map")
    sql["label_map_from_csv"] = sql["label_map_explode"]
    add(
        "new_labels",
        """select distinct class_name from image_objects
 where class_name not in (select class_name from earlier_label_map)""",
        "image_objects",
        "earlier_label_map",
    )
    add(
        "label_map_update",
        """select class_name, label_id from earlier_label_map union all
 select class_name, cast((select max(label_id) from earlier_label_map) + row_number() over (order by class_name) as int)
 from (select distinct class_name from image_objects
  where class_name not in (select class_name from earlier_label_map)) t""",
        "image_objects",
        "earlier_label_map",
    )
    # training set
    add(
        "training_examples",
        "select filename, class_name, label_id from training_examples",
        "training_examples",
    )
    add("read_examples", "select filename, label_id from training_examples", "training_examples")
    add("dataset_size", "select count(*) as dataset_size from training_examples", "training_examples")
    add(
        "class_distribution",
        """select 'v3_10' as model_version, class_name as class_label, label_id, count(*) as example_count
 from training_examples group by class_name, label_id""",
        "training_examples",
    )
    add("replay_sample", "select version, path from replayed", "replayed")
    for key, excluded in (("replay_sample_pooled", "v3_10"), ("replay_sample_pooled_next", "v3_11")):
        add(
            key,
            f"""select path from (select path,
 row_number() over (order by md5(concat('42|',path)), path) as rn, count(*) over () as n
 from image_objects where path like '%.jpg' and version <> '{excluded}') t
 where rn <= floor(n * 0.2::double)""",
            "image_objects",
        )
    add("training_paths", "select path, origin from training_files", "training_files")
    add(
        "training_set",
        """select e.path, f.origin, e.filename, e.class_name, e.label_id
 from training_files f join training_examples e on e.path = f.path""",
        "training_files",
        "training_examples",
    )
    add(
        "train_val_split",
        """select filename, case when position <= floor(total * 0.3::double) then 'val' else 'train' end as part
 from ordered_examples""",
        "ordered_examples",
    )
    add(
        "split_sizes",
        """select n as dataset_size, v as val_size, n - v as train_size,
 cast((n - v) // 32 as bigint) as steps_per_epoch, cast(v // 32 as bigint) as validation_steps
 from (select count(*) as n, cast(floor(count(*) * 0.3::double) as bigint) as v from training_examples) t""",
        "training_examples",
    )
    add("shuffled_examples", "select filename, position from ordered_examples", "ordered_examples")
    add(
        "batch_counts",
        """select cast((position - 1) // 32 as bigint) as batch_id, count(*) as n
 from ordered_examples group by 1""",
        "ordered_examples",
    )
    add(
        "class_weights",
        """select label_id, round(raw / max(raw) over (), 6) as weight from (
 select m.label_id, (select count(*) from training_examples)::double
  / ((select count(distinct label_id) from earlier_label_map) * coalesce(c.n, 1)) as raw
 from (select distinct label_id from earlier_label_map) m
 left join (select label_id, count(*) as n from training_examples group by label_id) c
 on c.label_id = m.label_id) t""",
        "training_examples",
        "earlier_label_map",
    )
    add(
        "label_histogram",
        """select t.label_id, case when t.class_name like '% fr' then concat('Unknown ID: ', t.label_id)
  else t.class_name end as label_name, t.n, round(t.n::double / sum(t.n) over () * 100, 6) as pct
 from (select m.label_id, m.class_name, count(*) as n from paired join label_map m
  on m.class_name = paired.api_label group by 1, 2) t""",
        "paired",
        "label_map",
    )
    add(
        "duplicate_files",
        """select concat(class_name,'_',cast(doc_id % 20 as varchar)) as filename, count(*) as n
 from image_objects group by 1 having count(*) > 1""",
        "image_objects",
    )
    add(
        "file_stats",
        """select count(*) as unique_files, cast(sum(n) as bigint) as total_files,
 count(*) filter (where n > 1) as duplicate_files
 from (select concat(class_name,'_',cast(doc_id % 20 as varchar)) as filename, count(*) as n
 from image_objects group by 1) t""",
        "image_objects",
    )
    # metrics
    add(
        "champion_scores",
        """select model_version, round(acc, 6) as avg_prediction_accuracy from champion_accuracy""",
        "champion_accuracy",
    )
    add(
        "champion_winner",
        """select champion, challenger, round(champion_score, 6) as champion_score,
 round(challenger_score, 6) as challenger_score,
 case when challenger_score > champion_score then challenger else champion end as winner from evaluated""",
        "evaluated",
    )
    add(
        "promotion_step",
        """select winner, winner as champion_version, 'v3_11' as challenger_version,
 case when winner <> champion then 'champion-service' else 'challenger-service' end as service_to_update,
 case when winner <> champion then winner else challenger end as previous_model_version
 from (select *, case when challenger_score > champion_score then challenger else champion end as winner
 from evaluated) t""",
        "evaluated",
    )
    add(
        "breed_accuracy",
        """select coalesce(round_even(avg(case when is_correct then 1.0::double else 0.0::double end) * 100, 2),
 0.0::double) as accuracy from prediction_metrics where model_version = 'v3_3' and actual = 'click'""",
        "prediction_metrics",
    )
    add(
        "top_breeds",
        """select actual as breed, count(*) as total,
 cast(sum(case when is_correct then 1 else 0 end) as bigint) as correct,
 round(sum(case when is_correct then 1 else 0 end)::double / count(*), 6) as accuracy
 from prediction_metrics where model_version = 'v3_3' group by actual
 order by sum(case when is_correct then 1 else 0 end)::double / count(*) desc, breed limit 10""",
        "prediction_metrics",
    )
    add(
        "latest_distribution",
        "select model_version, class_label, example_count, run_timestamp from newest",
        "newest",
    )
    add(
        "top_classes",
        """select model_version, class_label, example_count from newest where model_version = 'v3_3'
 order by example_count desc, class_label limit 3""",
        "newest",
    )
    add(
        "confusion_matrix",
        """select model_version, actual, predicted, count(*) as n from prediction_metrics group by 1,2,3""",
        "prediction_metrics",
    )
    add("confusion_pack", "select model_version, ts, confusion_matrix from model_metrics", "model_metrics")
    add(
        "confusion_chunks",
        """, cells as (select model_version, date_trunc('day', ts)::timestamp as ts, actual, predicted, count(*) as n
 from prediction_metrics group by all),
labels_ as (select model_version, ts, actual, count(*) as k from cells group by all),
placed as (select *, cast(floor(coalesce(sum(k) over (partition by model_version, ts order by actual
  rows between unbounded preceding and 1 preceding), 0) / 3) as int) as chunk from labels_)
select model_version, ts, chunk, string_agg(concat(actual,':',predicted,':',cast(n as varchar)), '|'
  order by concat(actual,':',predicted,':',cast(n as varchar))) as confusion_matrix
from cells join placed using (model_version, ts, actual) group by model_version, ts, chunk""",
        "prediction_metrics",
    )
    add(
        "confusion_unpack",
        """select model_version, ts, split_part(e,':',1) as true_label, split_part(e,':',2) as predicted_label,
 cast(split_part(e,':',3) as bigint) as count
 from (select model_version, ts, unnest(string_split(confusion_matrix,'|')) as e from model_metrics
 where ts between timestamp '2024-01-05' and timestamp '2024-01-20') t""",
        "model_metrics",
    )
    add(
        "metrics_hourly",
        """select date_trunc('hour', ts)::timestamp as hour, model_version, count(*) as n,
 round(avg(is_correct::int), 6) as accuracy, round(avg(latency), 6) as avg_latency,
 round(quantile_cont(latency, 0.5), 6) as p50_latency, round(quantile_cont(latency, 0.95), 6) as p95_latency
 from prediction_metrics group by 1, 2""",
        "prediction_metrics",
    )
    add(
        "latest_run_only",
        """select model_version, class_label, example_count, run_timestamp from class_distribution
 qualify run_timestamp = max(run_timestamp) over (partition by model_version)""",
        "class_distribution",
    )
    add(
        "retrain_gate",
        "select version, count(*) as n, count(*) >= 46 as retrain from wrong_images group by version",
        "wrong_images",
    )
    add(
        "kl_divergence",
        """select round(sum(p * ln(p / q)), 6) as kl from (
 select (coalesce(a.c, 0) + 1)::double / sum(coalesce(a.c, 0) + 1) over () as p,
  (coalesce(b.c, 0) + 1)::double / sum(coalesce(b.c, 0) + 1) over () as q
 from (select class_label, example_count as c from newest where model_version = 'v3_3') a
 full join (select class_label, example_count as c from newest where model_version = 'v3_10') b
 on a.class_label = b.class_label) t""",
        "newest",
    )
    add(
        "routed_predictions",
        """select event_id, concat(model_version, '/',
 case when is_correct then 'correct_predictions/' else 'incorrect_predictions/' end,
 case when is_correct then predicted else actual end, '_',
 cast(cast(floor(epoch(ts)) as bigint) as varchar), '_', cast(event_id as varchar)) as path
 from prediction_metrics where model_version <> 'v3_0'""",
        "prediction_metrics",
    )
    add(
        "describe_table",
        """select * from (values
 ('model_version', 'STRING', 'REQUIRED', 'version trained on the examples'),
 ('class_label', 'STRING', 'REQUIRED', 'name of the class'),
 ('label_id', 'INTEGER', 'REQUIRED', 'id of the class'),
 ('example_count', 'INTEGER', 'REQUIRED', 'examples of the class'),
 ('run_timestamp', 'TIMESTAMP', 'REQUIRED', 'start of the run')) as t(name, type, mode, description)""",
    )
    # functions
    versions = (
        "(select distinct version from image_objects union select 'v3_0' union select 'bad' union select null) v"
    )
    add(
        "valid_version_ids",
        """select version, regexp_matches(version, '^[a-zA-Z0-9_-]+$') as ok from (
 select distinct version from image_objects union select 'v 3' union select 'v3/1' union select '') v""",
        "image_objects",
    )
    add(
        "parse_versions",
        f"""select version, try_cast(regexp_extract(version, '^v(\\d+)_(\\d+)', 1) as int) as major,
 try_cast(regexp_extract(version, '^v(\\d+)_(\\d+)', 2) as int) as minor from {versions}""",
        "image_objects",
    )
    add(
        "next_version",
        f"""select version, case when regexp_full_match(version, 'v\\d+_\\d+') then
 concat(split_part(version,'_',1), '_', cast(try_cast(split_part(version,'_',2) as int) + 1 as varchar))
 end as next from {versions}""",
        "image_objects",
    )
    add(
        "training_mode",
        f"""select version, case when version is null or version = 'v3_0'
 or not regexp_matches(version, '^v\\d+_\\d+') then 'new' else 'warm_start' end as mode from {versions}""",
        "image_objects",
    )
    add(
        "strict_versions",
        """select version, case when ok then split_part(version, '_', 1) end as prefix,
 case when ok then try_cast(split_part(version, '_', 2) as int) end as number
 from (select version, coalesce(len(string_split(version, '_')) = 2
   and try_cast(split_part(version, '_', 2) as int) is not null, false) as ok
  from (select distinct version from image_objects union select unnest(['v3_0', 'bad', 'v3_1_2', 'v3_x', null])) t) u""",
        "image_objects",
    )
    add(
        "whole_numbers",
        """select value, regexp_full_match(value, '[0-9]+') as ok from (
 select distinct o_orderstatus as value from orders union all select cast(r_regionkey as varchar) from region) t""",
    )
    add(
        "time_texts",
        """select event_id, strftime(ts, '%Y-%m-%d-%H') as hour_folder,
 strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') as rfc3339 from events""",
    )
    add(
        "run_name",
        """select event_id, concat('training-', strftime(ts, '%Y%m%d-%H%M%S')) as run_name,
 concat('v3-', cast(user_id % 12 as varchar)) as experiment_name from events""",
    )
    add(
        "url_breed",
        "select page_id, replace(split_part(url,'/',5),'-',' ') as breed from pages",
    )
    add(
        "normalize_label",
        f"""select label, array_to_string({_words('label')}, ' ') as words from (
 select distinct unnest([actual, predicted]) as label from label_pairs
 union select unnest(['german shepherd','alaskan malamute','blldog boston','terrier scottish','hound blood',
  'terrier kerryblue','Saint_Bernard','West_Highland_white_terrier','  Hound-Afghan_hound '])) t""",
        "label_pairs",
    )
    add(
        "fuzzy_ratio",
        f"""select actual, predicted, {_ratio('lower(actual)', 'lower(predicted)')} as ratio
 from (select distinct actual, predicted from label_pairs) t""",
        "label_pairs",
    )
    add(
        "compare_labels",
        f"""select p_partkey, case when a = p then true
  when len(a) = 0 or len(p) = 0 then lower(actual) = lower(predicted)
  when s >= 0.75 * len(a) and s >= 0.75 * len(p) then true
  when s = len(a) or s = len(p) then true
  else ratio >= 85 end as base_match, actual = predicted as tuned_match
 from (select *, len(list_intersect(a, p)) as s from (
  select p_partkey, actual, predicted, {_words('actual')} as a, {_words('predicted')} as p,
  {_ratio('lower(actual)', 'lower(predicted)')} as ratio from label_pairs) t) u""",
        "label_pairs",
    )
    # scores
    add(
        "batch_predict",
        """select vec_id, cast(list_position(scores, list_max(scores)) - 1 as int) as predicted_id,
 round(list_max(scores), 6) as confidence from scores""",
        "scores",
    )
    add(
        "eval_accuracy",
        """select round(avg((list_position(scores, list_max(scores)) - 1 = label)::int), 6) as accuracy from scores""",
        "scores",
    )
    add(
        "eval_top5",
        """select round(avg((len(list_filter(scores, lambda x: x > scores[label + 1])) < 5)::int), 6)
 as top_5_accuracy from scores""",
        "scores",
    )
    add(
        "eval_xent",
        """select round(avg(-ln(greatest(least(scores[label + 1], 1 - 1e-7::double), 1e-7::double))), 6)
 as cross_entropy from scores""",
        "scores",
    )
    add(
        "training_metrics",
        """select concat('v3_', cast(vec_id % 12 as varchar)) as model_version,
 round(avg((list_position(scores, list_max(scores)) - 1 = label)::int), 6) as accuracy,
 round(avg((len(list_filter(scores, lambda x: x > scores[label + 1])) < 5)::int), 6) as top_k_accuracy
 from scores group by 1""",
        "scores",
    )
    add(
        "centroid_predict",
        """select vec_id, cast(arg_min(label, (dist, label)) as int) as predicted_id
 from distances group by vec_id""",
        "distances",
    )
    add(
        "scale_pixels",
        "select vec_id, round(list_min(px), 6) as min_v, round(list_max(px), 6) as max_v from pixel_rows",
        "pixel_rows",
    )
    def number(at: int) -> str:
        digit = "(strpos('0123456789abcdef', substr(h, {}, 1)) - 1)"
        return " + ".join(f"{digit.format(4 * at + k + 1)} * {16 ** (3 - k)}" for k in range(4))

    source = "case when {0} < 0 then -({0}) - 1 when {0} > 7 then 15 - ({0}) else {0} end"
    row, column = source.format("(i // 8 - down)"), source.format("(case when flip < 32768 then 7 - i % 8 else i % 8 end - sideways)")
    add(
        "augment_pixels",
        f"""select vec_id, 8 as height, 8 as width, 1 as n_channels, array_to_string(list_transform(lit,
  lambda p: printf('%02x', cast(greatest(0, least(255, floor(((p - mean) * stretch + 500) / 1000.0::double) + mean)) as int))), '') as image
 from (select *, cast(list_sum(lit) as bigint) // 64 as mean from (
  select *, list_transform(range(0, 64), lambda i: greatest(0, least(255, px[({row}) * 8 + ({column}) + 1] + light))) as lit from (
   select vec_id, list_transform(v, lambda x: cast(floor((x - low) / wide * 255) as bigint)) as px, {number(0)} as flip,
    ({number(1)}) * 3 // 65536 - 1 as down, ({number(2)}) * 3 // 65536 - 1 as sideways,
    ({number(3)}) * 103 // 65536 - 51 as light, ({number(4)}) * 401 // 65536 + 800 as stretch from (
    select vec_id, embedding::double[] as v, list_min(embedding::double[]) as low,
     list_max(embedding::double[]) - list_min(embedding::double[]) as wide, md5(concat('42|', vec_id)) as h from embeddings) a) b) c) d""",
    )
    # sinks
    add(
        "write_distribution",
        """select model_version, class_label, label_id::bigint as label_id, example_count, run_timestamp from newest""",
        "newest",
    )
    add(
        "write_distribution_once",
        "select model_version, class_label, label_id::bigint as label_id, example_count, run_timestamp from class_distribution",
        "class_distribution",
    )
    add(
        "write_predictions",
        """select ts as timestamp, actual, predicted, is_correct, round(latency, 6) as latency,
 round(confidence, 6) as confidence, model_version from prediction_metrics""",
        "prediction_metrics",
    )
    sql["write_predictions_mixed"] = sql["write_predictions"]
    add(
        "write_routed",
        """select model_version, outcome, concat(stem, '.jpg') as image_path,
 concat(stem, '_labels.json') as label_path,
 concat('{"model_label":"', predicted, '","api_label":"', actual, '"}') as label_json
 from (select *, concat(model_version, '/', outcome, '/', case when is_correct then predicted else actual end,
  '_', cast(cast(floor(epoch(ts)) as bigint) as varchar), '_', cast(event_id as varchar)) as stem
 from (select *, case when is_correct then 'correct_predictions' else 'incorrect_predictions' end as outcome
 from prediction_metrics where model_version <> 'v3_0') t) u""",
        "prediction_metrics",
    )
    sql["write_label_map"] = sql["label_map_explode"]
    sql["write_dataset_size"] = sql["dataset_size"]
    add("write_listing", "select label_path as path from label_objects", "label_objects")
    sql["write_training_metrics"] = sql["training_metrics"]
    add(
        "promotion_state",
        """select winner as champion,
 case when winner = champion then '2024-01-01T00:00:00Z' else '2024-02-01T00:00:00Z' end as champion_since,
 'v3_11' as challenger, cast(null as varchar) as challenger_since
 from (select *, case when challenger_score > champion_score then challenger else champion end as winner
 from evaluated) t""",
        "evaluated",
    )
    add(
        "prediction_log",
        f"""select make_timestamp((vec_id + 1700000000) * 1000000) as timestamp, actual, predicted,
 case when model_version = 'v3_0' then case when a = p then true
  when len(a) = 0 or len(p) = 0 then lower(actual) = lower(predicted)
  when s >= 0.75 * len(a) and s >= 0.75 * len(p) then true
  when s = len(a) or s = len(p) then true else ratio >= 85 end
 else actual = predicted end as is_correct,
 round((vec_id % 7) / 100.0::double, 6) as latency, round(list_max(scores), 6) as confidence, model_version
 from (select *, len(list_intersect(a, p)) as s from (
  select x.*, t.class_name as actual, m.class_name as predicted,
  {_words('t.class_name')} as a, {_words('m.class_name')} as p,
  {_ratio('lower(t.class_name)', 'lower(m.class_name)')} as ratio
  from (select *, concat('v3_', cast(vec_id % 2 as varchar)) as model_version,
   list_position(scores, list_max(scores)) - 1 as predicted_id from scores) x
  join label_map t on t.label_id = x.label join label_map m on m.label_id = x.predicted_id) y) z""",
        "scores",
        "label_map",
    )
    # streams
    add(
        "stream_ingest",
        """select event_id, ts, model_version, actual, predicted, is_correct, round(latency, 6) as latency,
 round(confidence, 6) as confidence from prediction_metrics""",
        "prediction_metrics",
    )
    sql["stream_dedup"] = sql["stream_ingest"]
    add(
        "stream_window_metrics",
        """select date_trunc('day', ts)::timestamp as window_start, model_version, count(*) as n,
 round(avg(is_correct::int), 6) as accuracy, round(avg(latency), 6) as avg_latency
 from prediction_metrics group by 1, 2""",
        "prediction_metrics",
    )
    add(
        "stream_late_rows",
        """, arrived as (
 select *, case when day(ts) <= 10 then 0 when day(ts) <= 20 then 1 else 2 end
  + case when event_id % 40 = 7 then 1 else 0 end as arrival from prediction_metrics),
marks as (
 select a.arrival, max(b.ts) - interval 1 hour as mark
 from (select distinct arrival from arrived) a left join arrived b on b.arrival < a.arrival group by a.arrival),
judged as (
 select *, coalesce(date_trunc('day', ts) + interval 1 day <= mark, false) as late from arrived join marks using (arrival))
select date_trunc('day', ts)::timestamp as window_start, model_version, count(*) filter (where not late) as n,
 round(avg(is_correct::int) filter (where not late), 6) as accuracy, count(*) filter (where late) as n_late
from judged group by 1, 2""",
        "prediction_metrics",
    )
    add(
        "stream_running_accuracy",
        """select model_version, round(avg(is_correct::int), 6) as avg_prediction_accuracy
 from prediction_metrics group by model_version""",
        "prediction_metrics",
    )
    add(
        "deployed_texts",
        """select event_id, concat(strftime(moment, '%Y-%m-%dT%H:%M:%S'), case when strftime(moment, '%f') <> '000000'
 then concat('.', strftime(moment, '%f')) else '' end, 'Z') as deployed_at
 from (select event_id, ts + to_microseconds(event_id % 3 * 250) as moment from events)""",
    )
    # stored objects
    add(
        "list_stored_objects",
        """select path, case when version = 'v3_10' then 'current' else 'earlier' end as kind from wrong_images
 where version = 'v3_10' or cast(split_part(version,'_',2) as int) < 10""",
        "wrong_images",
    )
    add(
        "discover_objects",
        """select path, case when doc_id % 17 = 0 then 8 else 246 end::bigint as length from image_objects
 where version in ('v3_3', 'v3_4')
 union all select label_path, octet_length(value::blob)::bigint from label_objects where label_path like 'v3\\_3/%' escape '\\'
  or label_path like 'v3\\_4/%' escape '\\'""",
        "image_objects",
        "label_objects",
    )
    add(
        "preprocess_job",
        """select path, coalesce(reason, case when doc_id % 17 = 0 then 'bad_image' else 'none' end) as reason,
 split_part(split_part(path,'/',3),'.',1) as filename, api_label as class_name, label_id::bigint as label,
 case when reason is null and doc_id % 17 <> 0 then (select array_to_string(list_transform(v, lambda x:
   repeat(printf('%02x', cast(floor((x - list_min(v)) / (list_max(v) - list_min(v)) * 255) as int)), 3)), '')
  from (select embedding::double[] as v from embeddings where vec_id = doc_id % 500) e) end as image
from (select f.path, w.doc_id, api_label, label_id, case when label_path is null then 'missing_label'
   when not json_valid(value) then 'bad_json' when api_label is null then 'no_api_label' when label_id is null then 'unknown_label' end as reason
  from training_files f join wrong_images w on w.path = f.path
  left join (select *, case when json_valid(value) then value->>'$.api_label' end as api_label from label_objects) l
   on l.label_path = replace(f.path, '.jpg', '_labels.json')
  left join earlier_label_map m on m.class_name = l.api_label) t""",
        "training_files",
        "label_objects",
        "earlier_label_map",
    )
    return sql
