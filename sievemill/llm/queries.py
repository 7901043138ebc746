"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sievemill.llm.ann import op9_approximate_nearest_neighbours
from sievemill.llm.embedding_dedup import op4_embedding_near_dedup
from sievemill.llm.licences import op10_license_scan
from sievemill.llm.main_text import op2_html_extraction
from sievemill.llm.minhash_dedup import op7_minhash_near_dedup
from sievemill.llm.mixing import op5_temperature_mixing
from sievemill.llm.quality import op1_quality_classifier
from sievemill.llm.sentencepiece_codec import op8_sentencepiece
from sievemill.llm.session import with_checkpoints
from sievemill.llm.substring_dedup import op3_substring_dedup
from sievemill.llm.url_rules import op6_url_filters

_QUERIES = [
    op1_quality_classifier,
    op2_html_extraction,
    op3_substring_dedup,
    op4_embedding_near_dedup,
    op5_temperature_mixing,
    op6_url_filters,
    op7_minhash_near_dedup,
    op8_sentencepiece,
    op9_approximate_nearest_neighbours,
    op10_license_scan,
]

_WORDS = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Every node that a node reaches over links (a, b), both ways.
_REACH = "reach(a, b) as (select a, b from both_ways union select r.a, l.b from reach r join both_ways l on l.a = r.b)"

_SUBSTRINGS = f"""with w as (select doc_id, {_WORDS.format("coalesce(text, '')")} words from documents),
starts as (select doc_id, words, unnest(range(1, len(words) - 18)) s from w),
placed as (select doc_id, s, row_number() over (partition by array_to_string(words[s:s + 19], ' ') order by doc_id, s) n from starts),
gone as (select distinct doc_id, unnest(range(s, s + 20)) pos from placed where n > 1),
each as (select doc_id, unnest(words) word, unnest(range(1, len(words) + 1)) pos from w),
kept as (select doc_id, string_agg(word, ' ' order by pos) kept from each anti join gone using (doc_id, pos) group by doc_id),
cut as (select doc_id, count(*) n from gone group by doc_id)
select w.doc_id, len(words) as n_words, coalesce(cut.n, 0) as n_removed, sha256(coalesce(kept.kept, '')) as kept_sha256
from w left join kept using (doc_id) left join cut using (doc_id)"""

_NEAR = f"""with recursive w as (select doc_id, {_WORDS.format(_LOWER)} words from documents),
s as (select doc_id, case when len(words) = 1 then words else list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) end shingles from w),
n as (select doc_id, shingles, len(shingles) n from s),
pairs as (select x.doc_id a, y.doc_id b, x.n + y.n total, len(list_intersect(x.shingles, y.shingles)) common from n x join n y on x.doc_id < y.doc_id and x.n > 0 and y.n > 0 and 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
links as (select a, b from pairs where 100 * common >= 80 * (total - common)),
both_ways as (select a, b from links union all select b, a from links),
{_REACH},
c as (select a, least(a, min(b)) component from reach group by a)
select doc_id, n as n_shingles, coalesce(component, doc_id) as component_id, coalesce(component, doc_id) = doc_id as kept from n left join c on a = doc_id"""

_VECTORS = f"""with recursive v as (select vec_id, embedding::double[] e from embeddings where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (select x.vec_id a, y.vec_id b from v x join v y on x.vec_id < y.vec_id and len(x.e) = len(y.e) where list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.95),
both_ways as (select a, b from links union all select b, a from links),
{_REACH},
c as (select a, least(a, min(b)) component from reach group by a),
d as (select a, count(*) n from both_ways group by a)
select vec_id, coalesce(n, 0) as n_links, coalesce(component, vec_id) as component_id, coalesce(component, vec_id) = vec_id as kept from embeddings left join c on c.a = vec_id left join d on d.a = vec_id"""


#: The article element of pages as plain text: blocks by line, references decoded as far as the tables have them.
_MAIN_TEXT = r"""with a as (select page_id, url, regexp_replace(regexp_extract(html, '<article>(.*?)</article>', 1, 's'), '<br>', ' ', 'g') body from pages),
b as (select page_id, url, list_transform(string_split_regex(body, '</?(?:p|h1|ul|li|div)\b[^>]*>'), lambda x: regexp_replace(x, '<[^>]*>', '', 'g')) parts from a),
c as (select page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(x, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g'), '[\s]+', ' ', 'g'))) parts from b),
d as (select page_id, url, coalesce(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)), '') as text from c)
select page_id, url, text, length(text) as n_chars from d"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: (lambda spark, sf_dir, f=f: f(with_checkpoints(spark), sf_dir)) for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op2_html_extraction": _MAIN_TEXT, "op3_substring_dedup": _SUBSTRINGS, "op4_embedding_near_dedup": _VECTORS, "op7_minhash_near_dedup": _NEAR}
