"""DuckDB twins of the queries that SQL can express."""

#: base32 of a SHA-1: five hexadecimal digits are four characters.
_BASE32 = "array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + ((cast('0x' || substr(h, cast(1 + 5 * (k // 4) as bigint), 5) as bigint) >> cast(15 - 5 * (k % 4) as bigint)) & 31) as bigint), 1)), '')"

#: A-Z in lower case, whatever else there is.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: crc32 of x, a text: every byte is eight steps, the first of which takes it in.
_CRC32 = "xor(4294967295, list_reduce(flatten(list_transform(range(strlen(x)), lambda k: [cast('0x' || substr(hex(encode(x)), cast(2 * k + 1 as bigint), 2) as bigint), 0, 0, 0, 0, 0, 0, 0])), lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)), cast(4294967295 as bigint)))"

ORACLES: dict[str, str] = {
    "op11_spelling": f"""with recursive runs as (select coalesce(cast(doc_id as varchar), '') as d, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents),
    low as (select d, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from runs where length(run) >= 7 group by all),
    hashed as (select run, n, {_CRC32} as h from (select *, d || ':' || run as x from low)),
    words as (select word, cast(sum(n) as bigint) as n from (select n, case when h % 31 = 0 then left(run, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) + 2 as bigint)) else run end as word from hashed) where length(word) >= 7 group by word having sum(n) >= 2),
    cuts as (select word, i, left(word, i - 1) || substr(word, i + 1) as rest from (select word, unnest(range(1, length(word) + 1)) as i from words)),
    near as (select distinct a.word, b.word as other from cuts a join cuts b on a.i = b.i and a.rest = b.rest and a.word <> b.word union select c.word, w.word from cuts c join words w on w.word = c.rest union select w.word, c.word from cuts c join words w on w.word = c.rest),
    best as (select word, count(*) as n_near, arg_min(other, (-n, other)) as other, max(n) as top from near join (select word as other, n from words) using (other) group by word),
    own as (select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.top >= 10 * w.n then b.other end as form, case when b.top >= 10 * w.n then b.top end as form_n from words w left join best b using (word)),
    chain as (select word, word as at, form as next from own union all select c.word, o.word, o.form from chain c join own o on o.word = c.next)
    select o.word, o.form, c.at as root, o.n, o.n_near, o.form_n from own o join chain c on c.word = o.word and c.next is null""",
    "op12_collocations": rf"""with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?
-
]')) as p from documents), w as (select lang, list_filter(regexp_split_to_array(p, '[ 	]+'), lambda x: x <> '') as w from p),
    n as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
    g as (select lang, 1 as k, unnest(w) as phrase from w union all select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from w union all select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from w),
    f as (select lang, k, phrase, count(*) as f from g group by all having count(*) >= 10), c as (select *, string_split(phrase, ' ') as s from f where k > 1),
    cuts as (select lang, phrase, f, 1 as k, s[1] as a, array_to_string(s[2:], ' ') as b from c union all select lang, phrase, f, 2, s[1] || ' ' || s[2], s[3] from c where k = 3),
    scored as (select u.lang, u.phrase, u.f as a, x.f as l, y.f as r, cast(cast(1000000 as hugeint) * u.f * u.f // (cast(x.f as hugeint) * y.f) as bigint) as score, u.k from cuts u join f x on x.lang = u.lang and x.phrase = u.a join f y on y.lang = u.lang and y.phrase = u.b),
    one as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    holds as (select lang, phrase, max(f) as longer from (select lang, s[1] || ' ' || s[2] as phrase, f from c where k = 3 union all select lang, s[2] || ' ' || s[3], f from c where k = 3) group by all),
    kept as (select o.* from one o left join holds h using (lang, phrase) where h.longer is null or 100 * h.longer < 50 * o.a)
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from kept join n using (lang) qualify rank <= 2000""",
    "op13_decontamination": rf"""with d as (select row_number() over () as rid, doc_id, {_TERMS} as w from documents), i as (select coalesce(cast(item_id as varchar), '') as item, {_TERMS} as w from benchmark),
    win as (select distinct item, least(len(w), 10) as k, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda j: array_to_string(w[j : j + 9], ' '))) as g from i where len(w) > 0),
    grams as (select rid, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: {{'j': j, 'g': array_to_string(w[j : j + k - 1], ' ')}})) as x from d, (select distinct k from win) where len(w) >= k),
    hit as (select rid, k, x.j as j, x.g as g from grams where x.g in (select g from win)),
    words as (select rid, count(distinct place) as n_hit from (select rid, unnest(range(j, j + k)) as place from hit) group by rid),
    items as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct rid, item from hit join win using (g, k)) group by rid)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated from d left join words using (rid) left join items using (rid)""",
    "op2_warc": f"""with p as (select page_id, coalesce(url, '') as url, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages), m as (select h, max(page_id) as last, count(*) as n from p group by h)
    select page_id, strlen(html) as payload_bytes, {_BASE32} as payload_digest, case when page_id < last then 'revisit' else 'response' end as record_type, case when page_id < last then last end as refers_to, url from p join m using (h)""",
    "op9_nearest": """with e as (select vec_id, cast(embedding as double[]) as v from embeddings), n as (select vec_id, v, sqrt(list_dot_product(v, v)) as l from e where len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0), k as (select * from n where l > 0),
    s as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v) / (q.l * c.l) as score from k q join k c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5""",
}
