"""DuckDB SQL for the registered queries. It reads the source tables only."""

from __future__ import annotations

SITE = "https://www.jobs-example.sk"

# number -> "12 345"
SPACED = "replace(format('{{:,}}', CAST({0} AS BIGINT)), ',', ' ')"


def spaced(n: str) -> str:
    return SPACED.format(n)


LOW = "CAST(floor(o_totalprice / 100) AS BIGINT)"
PAY = f"""CASE o_orderstatus WHEN 'F' THEN {spaced(LOW)} || ' EUR/mesiac'
  WHEN 'O' THEN {spaced(LOW)} || ' - ' || {spaced(LOW + ' + 500')} || ' Kč/mesiac'
  ELSE 'Dohodou' END"""
OFFER_URL = f"'{SITE}/praca/c' || o_custkey || '/O' || (o_orderkey + 1000000)"
JOINED = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
LISTING = "(o_orderkey // 2000)"
PAGE = "((o_orderkey // 20) % 100 + 1)"
LISTING_URL = f"'{SITE}/praca/blok-' || {LISTING} || '/?page_num=' || {PAGE}"
LISTING_KEY = f"'{SITE}/praca/blok-' || {LISTING} || '/'"

URLS = f"""
  SELECT url FROM pages
  UNION ALL SELECT '{SITE}/praca/acme/O' || o_orderkey FROM orders
  UNION ALL SELECT 'http://JOBS-EXAMPLE.SK/praca/x/C' || c_custkey FROM customer
  UNION ALL SELECT '{SITE}/praca/?company_id=' || c_custkey || '&utm=1' FROM customer
  UNION ALL SELECT '{SITE}/praca/zoznam-lokalit/?p=' || s_suppkey FROM supplier
  UNION ALL SELECT '{SITE}/praca/zoznam-pozicii#' || s_suppkey FROM supplier
  UNION ALL SELECT '{SITE}/praca/zoznam-ine-veci~' || s_suppkey FROM supplier
  UNION ALL SELECT '{SITE}/partneri/?p=' || s_suppkey FROM supplier
  UNION ALL SELECT '{SITE}/?p=' || s_suppkey FROM supplier
  UNION ALL SELECT '{SITE}/praca#' || s_suppkey FROM supplier
  UNION ALL SELECT '{SITE}/praca/' || replace(p_name, ' ', '-') || '/?page_num=' || p_size FROM part
  UNION ALL SELECT 'https://notjobs-example.sk/praca/' || p_partkey FROM part
"""

# tags out, entities decoded
STRIPPED = r"""trim(replace(replace(replace(replace(regexp_replace(
  regexp_replace(html, '<script>.*?</script>|<style>.*?</style>|<!--.*?-->', '', 'gs'),
  '<[^>]*>', '', 'g'), '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&'),
  ' ' || chr(9) || chr(10) || chr(13))"""


def inner(tag: str) -> str:
    raw = f"regexp_extract(html, '<{tag}>([^<]*)</{tag}>', 1)"
    return f"nullif(trim(replace(replace({raw}, '&quot;', '\"'), '&amp;', '&')), '')"


MASK = ("'<Redacted property \"{0}\". To include the actual value, toggle ON the Actor input option"
        " \"Include personal data\">'")

Q: dict[str, str] = {}

Q["q01_read_pages"] = """
SELECT page_id, CASE WHEN contains(url, '#') THEN split_part(url, '#', 1) ELSE url END AS effective_url,
  length(html) AS html_chars FROM pages"""

Q["q02_numbers"] = f"""
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag <> 'R' THEN CAST(floor(round(l_extendedprice, 2)) AS BIGINT) END AS whole,
  CASE WHEN l_returnflag <> 'R' THEN round(l_extendedprice, 2) END AS exact,
  CASE WHEN l_returnflag <> 'R' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END AS cents,
  CASE WHEN l_returnflag <> 'R' THEN
    CAST(split_part(format('{{:,}}', CAST(floor(l_extendedprice) AS BIGINT)), ',', 1) AS BIGINT) END AS first_group,
  l_returnflag = 'R' AS missing
FROM lineitem"""

Q["q03_routes"] = rf"""
WITH u AS ({URLS}), t AS (
  SELECT url,
    regexp_matches(url, '(?i)\Wjobs-example\.sk/?([?#~]|$)') AS main,
    regexp_matches(url, '(?i)\Wjobs-example\.sk/praca/') AS board,
    regexp_matches(url, '/praca/.*?/O[0-9][0-9]') AS offer,
    regexp_matches(url, '/praca/.*?/C[0-9][0-9]') OR regexp_matches(url, 'company_id=[0-9][0-9]') AS company,
    regexp_matches(url, '(?i)\Wjobs-example\.sk/praca/zoznam-[a-z0-9-]+/?([?#~]|$)') AS list,
    regexp_matches(url, '(?i)\Wjobs-example\.sk/partneri/?([?#~]|$)') AS partner FROM u),
r AS (SELECT CASE WHEN main THEN 'mainPage' WHEN board AND offer THEN 'jobDetail' WHEN list THEN 'jobRelatedList'
    WHEN board THEN 'jobListing' WHEN partner THEN 'partners' ELSE 'none' END AS route,
  CASE WHEN list AND contains(url, 'zoznam-lokalit') THEN 'locations'
    WHEN list AND contains(url, 'zoznam-pozicii') THEN 'professions' END AS list_kind,
  coalesce(board AND company AND NOT main AND NOT offer, false) AS by_content FROM t)
SELECT route, list_kind, by_content, count(*) AS n FROM r GROUP BY ALL"""

Q["q03b_redirects"] = f"""
SELECT 'https://jobs-example.sk/praca' AS url, 'jobListing' AS label, '{SITE}/?p=' || s_suppkey AS parent_url,
  'redirect' AS reason FROM supplier"""

Q["q04_sinks"] = """
SELECT f.format, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
  CAST(sum(o_custkey) AS BIGINT) AS custkeys, count(DISTINCT o_orderpriority) AS priorities,
  count(*) FILTER (o_orderstatus = 'F') AS filled
FROM orders, (VALUES ('parquet'), ('json'), ('csv'), ('xml'), ('orc')) f(format) GROUP BY f.format"""

LOCATION_ROWS = """(SELECT count(*) FROM orders)
  + (SELECT count(*) FROM (SELECT DISTINCT o_orderkey // 50, o_orderstatus = 'F', o_orderpriority FROM orders))
  + (SELECT count(*) FROM (SELECT DISTINCT o_orderkey // 50, o_orderstatus = 'F' FROM orders))"""

Q["q05_fan_out"] = f"""
WITH c(kind, rows) AS (
  SELECT 'jobOffers', (SELECT count(*) FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderstatus <> 'P')
  UNION ALL SELECT 'companies', (SELECT count(*) FROM customer)
  UNION ALL SELECT 'locations', {LOCATION_ROWS}
  UNION ALL SELECT 'partners', (SELECT count(*) FROM supplier)
  UNION ALL SELECT 'industries', 0 UNION ALL SELECT 'professions', 0 UNION ALL SELECT 'languages', 0)
SELECT kind, CAST(rows AS BIGINT) AS rows, CAST(rows AS BIGINT) AS with_metadata FROM c"""

Q["q05b_archive"] = """
WITH c(kind, offers, run, rows, left_out) AS (
  SELECT 'listings', count(*) FILTER (o_orderpriority <> '1-URGENT'), 1,
    (SELECT count(*) FROM (SELECT DISTINCT o_orderkey // 2000, (o_orderkey // 20) % 100 FROM orders)), 0 FROM orders
  UNION ALL SELECT 'details', count(*) FILTER (o_orderstatus <> 'P'), 2, count(*) FILTER (o_orderstatus <> 'P'), (SELECT count(*) FROM pages) FROM orders
  UNION ALL SELECT 'both', count(*) FILTER (o_orderpriority <> '1-URGENT' OR o_orderstatus <> 'P'), NULL, NULL, NULL FROM orders)
SELECT kind, CAST(offers AS BIGINT) AS offers, CAST(run AS BIGINT) AS run, CAST(rows AS BIGINT) AS rows, CAST(left_out AS BIGINT) AS left_out FROM c"""

Q["q06b_company_listings"] = f"""
SELECT '{SITE}/praca/c/C' || (o_custkey + 100) || '?page_num=' || (o_orderkey // 20) AS listingUrl, 'O' || (o_orderkey + 1000000) AS offerId,
  {OFFER_URL} AS offerUrl, c_name AS employerName, CASE o_orderstatus WHEN 'F' THEN 'added' ELSE 'modified' END AS lastChangeType,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN {LOW} END AS salaryRangeLower
FROM {JOINED} WHERE o_orderpriority <> '1-URGENT' AND c_acctbal >= 0"""

Q["q06_quarantine"] = f"""
SELECT '{SITE}/praca/c/C' || (c_custkey + 100) AS url, 'companyDetailCustom' AS route,
  'custom-design company page' AS reason FROM customer WHERE c_acctbal < 0"""

Q["q07_page_text"] = f"""
SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, {inner('title')} AS title,
  lower({inner('h1')}) AS heading, md5({STRIPPED}) AS text_md5,
  CAST(len(regexp_extract_all(regexp_replace(html, '<script>.*?</script>', '', 'gs'), '<p>')) AS BIGINT) AS paragraphs
FROM pages"""

Q["q08_nav_links"] = r"""
WITH a AS (SELECT page_id, regexp_extract(url, '^(https?://[^/]*)', 1) AS site,
    regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1) AS hrefs,
    regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS texts FROM pages),
p AS (SELECT page_id, site, hrefs, texts, unnest(range(len(hrefs))) AS pos FROM a)
SELECT page_id, CAST(pos AS BIGINT) AS pos, CAST(pos + 1 AS BIGINT) AS item,
  site || replace(hrefs[pos + 1], '&amp;', '&') AS href,
  nullif(trim(replace(replace(texts[pos + 1], '&quot;', '"'), '&amp;', '&')), '') AS text,
  CAST(NULL AS VARCHAR) AS rest
FROM p"""

L9 = "CAST(floor(l_extendedprice) AS BIGINT)"
QTY = "CAST(l_quantity AS BIGINT)"
Q["q09_salaries"] = f"""
SELECT l_orderkey, l_linenumber,
  CASE l_linenumber WHEN 1 THEN {spaced(L9)} || ' EUR/mesiac' WHEN 2 THEN 'Od ' || {QTY} || ',5 EUR/hod.'
    WHEN 3 THEN {spaced(L9)} || ' - ' || {spaced(L9 + ' + ' + QTY)} || ' EUR/mesiac'
    WHEN 4 THEN {spaced(L9)} || ' - ' || {spaced(L9 + ' + ' + QTY)} || ' Kč/mesiac'
    WHEN 5 THEN {QTY} || '.5 - ' || ({QTY} + 1) || '.5 EUR/hod' WHEN 6 THEN {QTY} || ' EUR/deň'
    ELSE CASE WHEN l_returnflag <> 'A' THEN 'Od ' || {L9} || ' - ' || {L9} || ' EUR/mesiac' END END AS "salaryRange",
  CASE WHEN l_linenumber IN (1, 3, 4) THEN {L9} WHEN l_linenumber IN (2, 5, 6) THEN {QTY} END AS "salaryRangeLower",
  CASE WHEN l_linenumber IN (3, 4) THEN {L9} + {QTY} WHEN l_linenumber = 5 THEN {QTY} + 1 END AS "salaryRangeUpper",
  CASE WHEN l_linenumber = 4 THEN 'kč' WHEN l_linenumber IN (1, 2, 3, 5, 6) THEN 'eur' END AS "salaryCurrency",
  CASE WHEN l_linenumber IN (1, 3, 4) THEN 'month' WHEN l_linenumber IN (2, 5) THEN 'hour'
    WHEN l_linenumber = 6 THEN 'de' END AS "salaryPeriod"
FROM lineitem"""

CARDS = f"""
SELECT {LISTING_URL} AS "listingUrl", c_name AS "employerName",
  CASE WHEN c_mktsegment <> 'BUILDING' THEN '{SITE}/praca/c' || o_custkey || '/C' || (o_custkey + 1000) END AS "employerUrl",
  CASE WHEN c_mktsegment <> 'BUILDING' THEN '{SITE}/logo/' || o_custkey || '.png' END AS "employerLogoUrl",
  'Order ' || o_orderkey || ' & co' AS "offerName", {OFFER_URL} AS "offerUrl",
  'O' || (o_orderkey + 1000000) AS "offerId", n_name AS location,
  c_mktsegment || CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '|' || o_orderpriority END AS labels,
  'pred ' || c_nationkey || ' dňami' AS "lastChangeRelativeTime",
  CASE WHEN o_orderstatus = 'F' THEN 'added' ELSE 'modified' END AS "lastChangeType", {PAY} AS "salaryRange",
  CASE WHEN o_orderstatus <> 'P' THEN {LOW} END AS "salaryRangeLower",
  CASE WHEN o_orderstatus = 'O' THEN {LOW} + 500 END AS "salaryRangeUpper",
  CASE o_orderstatus WHEN 'F' THEN 'eur' WHEN 'O' THEN 'kč' END AS "salaryCurrency",
  CASE WHEN o_orderstatus <> 'P' THEN 'month' END AS "salaryPeriod"
FROM {JOINED} WHERE o_orderpriority <> '1-URGENT'"""
Q["q10_listing"] = CARDS

Q["q11_detail"] = f"""
SELECT '{SITE}/praca/p/O' || (p_partkey + 1000) || '?s=' || p_size AS "offerUrl", 'O' || (p_partkey + 1000) AS "offerId",
  p_name AS "offerName", p_brand AS "employerName", '{SITE}/praca/f' || p_size AS "employerUrl",
  'https://cdn.example.org/' || p_partkey || '.png' AS "employerLogoUrl", lower(p_type) AS labels,
  CASE p_type WHEN 'ECONOMY' THEN 'fte' WHEN 'STANDARD' THEN 'fte|selfemploy' WHEN 'SMALL' THEN ''
    WHEN 'PROMO' THEN 'voluntary|internship' ELSE 'pte' END AS "employmentTypes",
  p_size || '.5.2023' AS "startDate", 'Sklad ' || p_size AS location, '+421' || p_partkey || '|+420' AS "phoneNumbers",
  CAST(NULL AS VARCHAR) AS "datePosted", p_name || ' "x"' AS "jobInfoResponsibilities",
  p_name || ' "x"' AS "jobInfoBenefits", CAST(NULL AS VARCHAR) AS "jobInfoDeadline", p_type AS "jobReqEducation",
  CAST(NULL AS VARCHAR) AS "jobReqExpertise", p_type AS "jobReqIndustry", CAST(NULL AS VARCHAR) AS "jobReqOther",
  p_size || ' - ' || (p_size + 10) AS "employeeCount", 'Meno' || p_brand AS "employerContact"
FROM part"""

Q["q12_categories"] = f"""
SELECT 'O' || (c_custkey + 1000) AS "offerId", CAST(3 AS BIGINT) AS n_locations,
  n_name || '={SITE}/praca/n' || n_nationkey || '/|' || r_name || '={SITE}/praca/k/r' || r_regionkey || '|' || c_name
    AS locations,
  c_mktsegment || '={SITE}/praca/k/O' || (c_custkey + 1000) || '?m=1|' || c_name AS professions
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

Q["q13_locations"] = f"""
WITH o AS (SELECT o_orderkey // 50 AS blok, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS tab,
    o_orderpriority AS prio, o_orderkey, o_totalprice FROM orders),
rows AS (
  SELECT blok, tab, '{SITE}/praca/vsetko/' AS url, 'All' AS name, 0 AS n, NULL AS heading FROM o GROUP BY ALL
  UNION ALL SELECT blok, tab, '{SITE}/praca/' || lower(replace(prio, ' ', '-')) || '/', prio, count(*), prio
    FROM o GROUP BY blok, tab, prio
  UNION ALL SELECT blok, tab, '{SITE}/praca/o' || o_orderkey || '/', 'Order ' || o_orderkey,
    CAST(floor(o_totalprice) AS BIGINT), prio FROM o)
SELECT '{SITE}/praca/zoznam-lokalit/?blok=' || blok || '&tab_index=' || tab AS page, url, name,
  CAST(n AS BIGINT) AS count, CASE WHEN tab = 0 THEN heading END AS region,
  CASE WHEN tab = 0 THEN 'Slovenská republika' ELSE heading END AS country FROM rows"""

Q["q13b_companies"] = f"""
SELECT '{SITE}/praca/c/C' || c_custkey AS url, c_name AS name, CAST(c_nationkey AS BIGINT) AS count FROM customer"""

Q["q14_result_totals"] = f"""
SELECT '{SITE}/praca/zakaznik-' || c_custkey || '/' AS listing,
  CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE count(*) * 137 END AS BIGINT) AS total
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_mktsegment"""

Q["q15_partners"] = f"""
WITH s AS (SELECT *, max(n_regionkey) OVER (PARTITION BY s_suppkey // 50) AS last_region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_name AS name, 'http://p' || s_suppkey || '.example.org/' AS url, 'from ' || n_name AS description,
  '{SITE}/l' || s_suppkey || '.png' AS "logoUrl",
  CASE WHEN n_regionkey < last_region THEN 'Region ' || n_regionkey END AS category FROM s"""

Q["q15b_tabs"] = f"""
WITH o AS (SELECT o_orderkey // 50 AS blok, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS tab, o_orderpriority
  FROM orders)
SELECT '{SITE}/praca/zoznam-lokalit/?blok=' || blok || '&tab_index=' || tab AS page,
  CASE tab WHEN 0 THEN 'Slovensko' ELSE 'Zahraničie' END AS tab_name, CAST(tab AS BIGINT) AS tab_index,
  CAST(1 + count(DISTINCT o_orderpriority) + count(*) AS BIGINT) AS links FROM o GROUP BY blok, tab"""

Q["q16_urls"] = r"""
WITH p AS (SELECT page_id, url, split_part(url, '#', 1) AS nofrag, split_part(split_part(url, '#', 1), '?', 1) AS bare,
    contains(url, '?') AS has_q, split_part(split_part(url, '#', 1), '?', 2) AS q,
    CASE WHEN contains(url, '#') THEN '#top' ELSE '' END AS frag FROM pages),
s AS (SELECT *, regexp_extract(bare, '^(https?://[^/]*)', 1) AS site FROM p)
SELECT page_id, bare || '?a=1+x&b=2&b=1' || CASE WHEN has_q THEN '&' || q ELSE '' END || frag AS sorted,
  bare || '?a=1+x&b=2&b=1' || CASE WHEN has_q THEN '&' || q ELSE '' END AS key,
  bare || '?' || CASE WHEN has_q THEN q || '&' ELSE '' END || 'b=n&a=1+x' || frag AS replaced,
  bare || '?' || CASE WHEN has_q THEN q || '&' ELSE '' END || 'z=' || page_id || frag AS added,
  nullif(regexp_extract(q, '(^|&)page=([^&]*)', 2), '') AS page,
  CASE WHEN regexp_matches(bare, '^https?://[^/]*/[^/]*/[^/]*/$')
    THEN regexp_extract(bare, '^(https?://[^/]*/[^/]*/)', 1) ELSE site || '/' END || 'up?x=1' AS up,
  site || '/root?' || CASE WHEN has_q THEN q || '&' ELSE '' END || 'b=2&a=1%20x&b=1' || frag AS kept,
  site || '/p?' || CASE WHEN has_q THEN q || '&' ELSE '' END || 'b=2&a=1%20x&b=1' || frag AS moved,
  false AS same
FROM s"""

Q["q17_max_entries"] = f"""
SELECT listing, page_num, "offerId" FROM (
  SELECT {LISTING_KEY} AS listing, CAST({PAGE} AS BIGINT) AS page_num, 'O' || (o_orderkey + 1000000) AS "offerId",
    row_number() OVER (PARTITION BY {LISTING} ORDER BY o_orderkey) AS rn
  FROM orders WHERE o_orderpriority <> '1-URGENT') WHERE rn <= 50"""

Q["q17b_until_empty"] = f"""
SELECT {LISTING_KEY} AS listing, count(*) AS n, CAST(max({PAGE}) AS BIGINT) AS last_page
FROM orders WHERE o_orderpriority <> '1-URGENT' AND {PAGE} < 40 GROUP BY 1"""

Q["q17c_run_limit"] = f"""
SELECT "offerId", "offerName" FROM (
  SELECT c."offerId", c."offerName", row_number() OVER (ORDER BY k.listing, k.page_num, k.o_orderkey) AS rn
  FROM ({CARDS}) c JOIN (
    SELECT {LISTING_KEY} AS listing, CAST({PAGE} AS BIGINT) AS page_num, o_orderkey, 'O' || (o_orderkey + 1000000) AS id
    FROM orders) k ON k.id = c."offerId") WHERE rn <= 2500"""

Q["q18_missing_pages"] = f"""
WITH have AS (SELECT DISTINCT {LISTING} AS l, {PAGE} AS p FROM orders WHERE o_orderstatus <> 'P'),
shown AS (SELECT DISTINCT h.l, h.p FROM have h JOIN orders ON {LISTING} = h.l AND {PAGE} = h.p
  AND o_orderpriority <> '1-URGENT'),
need AS (SELECT l, p + 1 AS p FROM shown
  UNION SELECT l, p FROM (SELECT DISTINCT l FROM have), (SELECT unnest(range(1, 101)) AS p))
SELECT '{SITE}/praca/blok-' || l || '/?page_num=' || p AS url, 'jobListing' AS label,
  CAST(p AS BIGINT) AS listing_page_num
FROM need WHERE (l, p) NOT IN (SELECT (l, p) FROM have)"""

Q["q18c_frontier"] = f"""
WITH p AS (SELECT DISTINCT {LISTING} AS listing, {PAGE} AS page_num FROM orders),
l AS (SELECT DISTINCT o_orderkey // 50 AS blok, o_orderstatus = 'F' AS home FROM orders)
SELECT 'https://jobs-example.sk/praca' AS url, NULL AS label, 'seed' AS reason
UNION ALL SELECT 'https://www.jobs-example.sk/praca/zoznam-lokalit', NULL, 'seed'
UNION ALL SELECT '{SITE}/praca/blok-' || listing || '/?page_num=' || (page_num + 1), 'jobListing', 'next page'
  FROM p a WHERE NOT EXISTS (SELECT 1 FROM p b WHERE b.listing = a.listing AND b.page_num = a.page_num + 1)
    AND EXISTS (SELECT 1 FROM orders WHERE o_orderpriority <> '1-URGENT' AND {LISTING} = a.listing AND {PAGE} = a.page_num)
UNION ALL SELECT {OFFER_URL}, 'jobDetail', 'offer detail' FROM {JOINED} WHERE o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT'
UNION ALL SELECT '{SITE}/praca/zoznam-lokalit/?blok=' || blok || '&tab_index=' || i, 'jobRelatedList', 'list tab'
  FROM (SELECT DISTINCT blok FROM l) b, (VALUES (0), (1)) t(i) WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.blok = b.blok AND l.home AND i = 0)"""

Q["q18d_announced_gaps"] = f"""
WITH t AS (SELECT c_custkey, count(*) * 137 AS total FROM customer JOIN orders ON c_custkey = o_custkey
  WHERE c_mktsegment <> 'MACHINERY' GROUP BY c_custkey)
SELECT '{SITE}/praca/zakaznik-' || c_custkey || '/' AS listing, CAST(2 AS BIGINT) AS first, CAST((total + 19) // 20 - 1 AS BIGINT) AS last
FROM t WHERE (total + 19) // 20 > 2"""

# the newest capture is of day 9, so days before 6 are late in the second and third file, unless the first has their URL
Q["q24b_late_captures"] = """
WITH d AS (SELECT split_part(url, '#', 1) AS u, page_id % 10 AS day FROM pages),
k AS (SELECT u, max(day) >= 8 OR bool_or(day >= 6) AS known FROM d GROUP BY u)
SELECT CAST(2 * count(*) AS BIGINT) AS captures, CAST(count(DISTINCT d.u) FILTER (known) AS BIGINT) AS kept,
  CAST(2 * count(*) FILTER (NOT known) AS BIGINT) AS late,
  CAST(2 * count(*) - count(DISTINCT d.u) FILTER (known) - 2 * count(*) FILTER (NOT known) AS BIGINT) AS again
FROM d JOIN k USING (u)"""

Q["q18b_filter_urls"] = f"""
WITH c AS (SELECT c_custkey, '{SITE}/praca/' AS a, lower(c_mktsegment) || '/?page_num=' AS b FROM customer)
SELECT c_custkey, a || b || c_custkey || '&salary=6&search_anywhere=asis+x&count_days=70&remote_work=2&salary_period=h'
    AS filtered,
  a || 'plny-uvazok/' || b || c_custkey || '&salary=100&salary_period=m' AS by_path,
  a || b || (c_custkey + 1) || '&salary=9' AS next_url, c_custkey AS page_num
FROM c"""

Q["q19_filters"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS "offerId", lower(o_orderpriority) AS "offerName", n_name AS location,
  strftime(o_orderdate, '%Y-%m-%d') AS "datePosted", CASE WHEN o_orderstatus = 'O' THEN {LOW} + 500 END AS "salaryRangeUpper"
FROM {JOINED}
WHERE (o_orderpriority IN ('1-URGENT', '2-HIGH') OR c_mktsegment = 'AUTOMOBILE')
  AND CASE WHEN o_orderstatus = 'O' THEN {LOW} + 500 ELSE {LOW} END >= 1500
  AND o_orderstatus = 'O' AND n_regionkey = 1
  AND CAST(o_orderdate AS DATE) >= DATE '2000-01-01' - 1500 AND n_name <> 'NATION_1'"""


def merged(listing: str) -> str:
    card = f"""{listing} AS "listingUrl",
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderstatus = 'F' THEN 'added' ELSE 'modified' END
    AS "lastChangeType",
  CASE WHEN o_orderpriority <> '1-URGENT' THEN 'pred ' || c_nationkey || ' dňami' END AS "lastChangeRelativeTime","""
    return f"""
SELECT 'O' || (o_orderkey + 1000000) AS "offerId", {OFFER_URL} AS "offerUrl", {card}
  'Detail ' || o_orderkey AS "offerName", CAST(NULL AS VARCHAR) AS "employerName", lower(o_orderpriority) AS labels,
  {LOW} AS "salaryRangeLower", CASE WHEN o_orderstatus = 'O' THEN {LOW} + 500 END AS "salaryRangeUpper",
  CASE WHEN o_orderstatus = 'F' THEN 'fte|selfemploy' ELSE 'pte' END AS "employmentTypes",
  strftime(o_orderdate, '%Y-%m-%d') AS "datePosted"
FROM {JOINED} WHERE o_orderstatus <> 'P'"""


Q["q20_merge"] = merged(LISTING_URL) + " AND o_orderpriority <> '1-URGENT'"
Q["q20b_merge_from_detail"] = merged(f"CASE WHEN o_orderpriority <> '1-URGENT' THEN {LISTING_URL} END")

Q["q20c_detail_pages"] = f"""
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS "lastChangeType", CAST(NULL AS VARCHAR) AS "lastChangeRelativeTime")
FROM ({merged('CAST(NULL AS VARCHAR)')})"""

Q["q21_only_new"] = """
WITH d AS (SELECT doc_id, lang, md5(text) AS key FROM documents)
SELECT key, min(doc_id) AS doc_id FROM d n
WHERE lang <> 'en' AND NOT EXISTS (SELECT 1 FROM d p WHERE (p.lang = 'en' OR p.doc_id < 100) AND p.key = n.key)
GROUP BY key"""

Q["q22_redact"] = f"""
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN {MASK.format('employerContact')} END AS "employerContact",
  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE {MASK.format('phoneNumbers')} END AS "phoneNumbers", false AS opted_in
FROM customer
UNION ALL SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name || '|' || c_mktsegment END, true FROM customer"""

Q["q23_rules"] = """
WITH r AS (SELECT page_id, CASE page_id % 10 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE url END AS name,
    contains(url, '#') AS site, split_part(url, ':', 1) AS country FROM pages)
SELECT rule, field, CAST(violations AS BIGINT) AS violations FROM (
  SELECT 'required' AS rule, 'name' AS field, (SELECT count(*) FROM r WHERE name IS NULL) AS violations
  UNION ALL SELECT 'not_empty', 'name', (SELECT count(*) FROM r WHERE name = '')
  UNION ALL SELECT 'required', 'url', 0
  UNION ALL SELECT 'site_url', 'url', (SELECT count(*) FROM r WHERE NOT site)
  UNION ALL SELECT 'required', 'count', 0
  UNION ALL SELECT 'int_not_negative', 'count', (SELECT count(*) FROM r WHERE page_id < 100)
  UNION ALL SELECT 'not_empty', 'region', 0
  UNION ALL SELECT 'required', 'country', 0
  UNION ALL SELECT 'not_empty', 'country', 0
  UNION ALL SELECT 'one_of', 'country', (SELECT count(*) FROM r WHERE country <> 'https')
  UNION ALL SELECT 'http_url', 'name', (SELECT count(*) FROM r WHERE name = ''))"""

Q["q23b_violations"] = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS "offerId", 'int_not_negative' AS rule, 'salaryRangeLower' AS field
FROM orders WHERE {LOW} < 1000
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'iso_date', 'datePosted' FROM orders WHERE o_orderpriority = '5-LOW'
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'required', 'startDate' FROM orders"""

Q["q24_stream"] = """
SELECT DISTINCT split_part(url, '#', 1) AS url_key FROM pages"""

Q["q25_salary_by_location"] = f"""
SELECT n_name AS location, CASE o_orderstatus WHEN 'F' THEN 'eur' ELSE 'kč' END AS "salaryCurrency",
  count(*) AS offers, CAST(sum({LOW}) AS BIGINT) AS sum_lower,
  max(CASE WHEN o_orderstatus = 'O' THEN {LOW} + 500 END) AS max_upper
FROM {JOINED} WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P' GROUP BY 1, 2"""

Q["q26_ingest"] = f"""
SELECT 'locations' AS kind, CAST({LOCATION_ROWS} AS BIGINT) AS rows
UNION ALL SELECT 'partners', (SELECT count(*) FROM supplier)
UNION ALL SELECT 'rejected', (SELECT count(*) FROM customer WHERE c_acctbal < 0)"""

Q["q26b_late_captures"] = f"""
SELECT "offerId", "offerName" FROM ({CARDS})"""

Q["q26c_detailed_ingest"] = Q["q20b_merge_from_detail"]


def oracle_sql() -> dict[str, str]:
    return dict(Q)
