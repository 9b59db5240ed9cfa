"""The entities as portable SQL over the base tables, for the checking queries only."""

from __future__ import annotations

import re

VIEWS = {
    "v_prop": """
SELECT o.o_orderkey AS prop_id,
  CASE WHEN o.o_orderkey % 4 = 3 THEN NULL ELSE o.o_orderkey - o.o_orderkey % 4 END AS lead_prop_id,
  o.o_custkey AS pi_id, c.c_nationkey AS inst_id,
  concat(CAST(10 + n.n_regionkey AS STRING), lpad(CAST(n.n_nationkey + 1 AS STRING), 6, '0')) AS org_code,
  o.o_orderpriority AS pgm_ele_code,
  CASE WHEN o.o_orderkey % 7 = 0 THEN '5-LOW' ELSE o.o_orderpriority END AS orig_pgm_ele_code,
  o.o_orderstatus AS prop_stts_code, c.c_mktsegment AS natr_rqst_code,
  o.o_totalprice AS rqst_dol, o.o_orderdate AS received_date,
  CASE WHEN o.o_orderstatus = 'O' THEN DATE '1900-01-01' ELSE o.o_orderdate + INTERVAL 90 DAY END AS dd_rcom_date,
  CAST(CASE WHEN o.o_orderkey % 5 = 0 THEN 0.75 ELSE 1.0 END AS DOUBLE) AS bas_rsch_pct,
  CAST(CASE WHEN o.o_orderkey % 10 = 0 THEN 0.25 ELSE 0.0 END AS DOUBLE) AS other_pct,
  concat('po', CAST(o.o_orderkey % 13 AS STRING)) AS pm_ibm_logn_id, CASE o.o_orderkey % 3 WHEN 0 THEN '4100' WHEN 1 THEN '4110' ELSE '4120' END AS obj_clas_code,
  concat('PA-', CAST(o.o_orderkey % 5 AS STRING)) AS pgm_annc_id, o.o_orderdate + INTERVAL 180 DAY AS rqst_eff_date, 12 + 12 * (o.o_orderkey % 5) AS rqst_mnth_cnt,
  CAST(CASE WHEN o.o_orderkey % 5 = 1 THEN 0.5 ELSE 0 END AS DOUBLE) AS apld_rsch_pct, CAST(CASE WHEN o.o_orderkey % 7 = 1 THEN 0.2 ELSE 0 END AS DOUBLE) AS educ_trng_pct, CAST(CASE WHEN o.o_orderkey % 9 = 1 THEN 0.1 ELSE 0 END AS DOUBLE) AS mjr_equp_pct, CAST(CASE WHEN o.o_orderkey % 11 = 1 THEN 0.05 ELSE 0 END AS DOUBLE) AS land_buld_fix_equp_pct, CAST(CASE WHEN o.o_orderkey % 13 = 1 THEN 0.3 ELSE 0 END AS DOUBLE) AS non_invt_pct,
  CASE WHEN o.o_orderkey % 6 = 0 THEN concat('C', CAST(o.o_orderkey % 4 AS STRING)) END AS cntx_stmt_id,
  CASE WHEN o.o_orderkey % 11 = 0 THEN '10000001' ELSE concat(CAST(10 + n.n_regionkey AS STRING), lpad(CAST(n.n_nationkey + 1 AS STRING), 6, '0')) END AS orig_org_code,
  concat(CASE WHEN o.o_orderkey % 23 = 0 THEN 'Goali: ' ELSE '' END, c.c_mktsegment, ' study ', CAST(o.o_orderkey - o.o_orderkey % 4 AS STRING),
         CASE WHEN o.o_orderkey % 29 = 1 THEN ' (revised)' ELSE '' END) AS prop_titl_txt
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
""",
    "v_org": """
SELECT concat(CAST(10 + n_regionkey AS STRING), lpad(CAST(n_nationkey + 1 AS STRING), 6, '0')) AS org_code, n_name AS dir_div_abbr FROM nation
UNION ALL SELECT concat(CAST(10 + r_regionkey AS STRING), '000000'), r_name FROM region
""",
    "v_pgm": """
SELECT * FROM (VALUES ('1-URGENT', 'Urgent'), ('2-HIGH', 'High'), ('3-MEDIUM', 'Medium'), ('4-NOT SPECIFIED', 'Not specified'), ('5-LOW', 'Low')) t(pgm_ele_code, pgm_ele_name)
""",
    "v_stts": """
SELECT * FROM (VALUES ('F', 'AWD', 'Awarded'), ('O', 'PEND', 'Pending'), ('P', 'DECL', 'Declined')) t(prop_stts_code, prop_stts_abbr, prop_stts_txt)
""",
    "v_class": """
SELECT * FROM (VALUES ('4100', 'Grants'), ('4110', 'Contracts'), ('4120', 'Fellowships')) t(obj_clas_code, obj_clas_name)
""",
    "v_rqst": """
SELECT * FROM (VALUES ('AUTOMOBILE', 'SUPP'), ('BUILDING', 'NEW'), ('FURNITURE', 'CONT'), ('HOUSEHOLD', 'TRAN'), ('MACHINERY', 'RNEW')) t(natr_rqst_code, natr_rqst_abbr)
""",
    "v_pi": """
SELECT c_custkey AS pi_id, c_name AS pi_last_name, concat('F', CAST(c_custkey % 10 AS STRING)) AS pi_frst_name, 'Y' AS prim_addr_flag, concat(lower(c_name), '@example.org') AS pi_emai_addr,
  c_nationkey AS inst_id, CASE WHEN c_custkey % 3 = 0 THEN 'F' ELSE 'M' END AS pi_gend_code,
  CASE WHEN c_custkey % 8 = 0 THEN 'H' ELSE 'N' END AS pi_ethn_code FROM customer
UNION ALL SELECT c_custkey, c_name, concat('F', CAST(c_custkey % 10 AS STRING)), 'N', concat(lower(c_name), '@old.example.org'), c_nationkey,
  CASE WHEN c_custkey % 3 = 0 THEN 'F' ELSE 'M' END, CASE WHEN c_custkey % 8 = 0 THEN 'H' ELSE 'N' END
FROM customer WHERE c_custkey % 5 = 0
""",
    "v_pdmog": """
SELECT c_custkey AS pi_id, 'R' AS dmog_tbl_code, CASE WHEN c_custkey % 4 = 0 THEN 'W' WHEN c_custkey % 4 = 1 THEN 'B3' ELSE 'A' END AS dmog_code FROM customer WHERE c_custkey % 6 <> 0
UNION ALL SELECT c_custkey, 'H', CASE WHEN c_custkey % 9 = 0 THEN 'Y' ELSE 'N' END FROM customer WHERE c_custkey % 2 = 0
""",
    "v_copi": """
SELECT DISTINCT l_orderkey AS prop_id, l_suppkey AS pi_id FROM lineitem WHERE l_linenumber = 2
""",
    "v_person": """
SELECT prop_id, pi_id, ' PI' AS pers FROM v_prop UNION ALL SELECT prop_id, pi_id, 'coPI' FROM v_copi
""",
    "v_atr": """
SELECT DISTINCT l.l_orderkey AS prop_id, 'PRC' AS prop_atr_type_code, lpad(CAST(p.p_size AS STRING), 4, '0') AS prop_atr_code
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
""",
    "v_atr_seq": """
SELECT l.l_orderkey AS prop_id, lpad(CAST(p.p_size AS STRING), 4, '0') AS prop_atr_code, CAST(min(l.l_linenumber) % 6 + 1 AS INT) AS prop_atr_seq
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY ALL
""",
    "v_rating": """
SELECT yn, string, CAST(score AS DOUBLE) AS score FROM (VALUES ('NNNNN','R',NULL),('NNNNY','P',1.0),('NNNYN','F',3.0),('NNNYY','F/P',2.0),('NNYNN','G',5.0),('NNYNY','G/P',2.98),('NNYYN','G/F',4.0),('NNYYY','G/F/P',2.99),
 ('NYNNN','V',7.0),('NYNNY','V/P',3.98),('NYNYN','V/F',4.98),('NYNYY','V/F/P',3.65),('NYYNN','V/G',6.0),('NYYNY','V/G/P',4.32),('NYYYN','V/G/F',4.99),('NYYYY','V/G/F/P',3.97),
 ('YNNNN','E',9.0),('YNNNY','E/P',4.992),('YNNYN','E/F',5.98),('YNNYY','E/F/P',4.325),('YNYNN','E/G',6.98),('YNYNY','E/G/P',4.995),('YNYYN','E/G/F',5.66),('YNYYY','E/G/F/P',4.5),
 ('YYNNN','E/V',8.0),('YYNNY','E/V/P',5.666),('YYNYN','E/V/F',6.33),('YYNYY','E/V/F/P',4.996),('YYYNN','E/V/G',6.99),('YYYNY','E/V/G/P',5.5),('YYYYN','E/V/G/F',5.99),('YYYYY','E/V/G/F/P',4.997)) AS t(yn, string, score)
""",
    "v_revr": """
SELECT s_suppkey AS revr_id, s_name AS revr_last_name, concat('F', CAST(s_suppkey % 10 AS STRING)) AS revr_frst_name,
  CASE WHEN s_suppkey % 12 = 0 THEN NULL ELSE s_nationkey END AS inst_id FROM supplier
""",
    "v_rev": """
SELECT g.prop_id, g.revr_id,
  CASE WHEN k % 11 = 0 THEN 'C' WHEN k % 13 = 0 THEN 'P' WHEN k % 17 = 0 THEN 'S' WHEN k % 19 = 0 THEN 'D' ELSE 'R' END AS rev_stts_code,
  CASE WHEN k % 5 = 0 THEN 'R' ELSE 'P' END AS rev_type_code,
  CASE k % 6 WHEN 0 THEN 'E' WHEN 1 THEN 'V' WHEN 2 THEN 'G' WHEN 3 THEN 'F' WHEN 4 THEN 'P' ELSE NULL END AS rev_prop_rtng_code,
  CASE WHEN k % 7 = 0 THEN NULL ELSE concat(CASE WHEN m % 32 >= 16 THEN 'Y' ELSE 'N' END, CASE WHEN m % 16 >= 8 THEN 'Y' ELSE 'N' END,
    CASE WHEN m % 8 >= 4 THEN 'Y' ELSE 'N' END, CASE WHEN m % 4 >= 2 THEN 'Y' ELSE 'N' END, CASE WHEN m % 2 >= 1 THEN 'Y' ELSE 'N' END) END AS rev_prop_rtng_ind,
  CASE WHEN k % 3 = 0 THEN 'Y' ELSE 'N' END AS rev_rlse_flag, CASE WHEN k % 21 = 1 THEN 'Y' ELSE 'N' END AS rev_prop_unrl_flag,
  CASE WHEN k % 25 = 0 THEN 'D' WHEN k % 4 = 0 THEN NULL ELSE 'S' END AS rev_subm_flag,
  CASE WHEN k % 13 = 0 OR k % 17 = 0 THEN NULL ELSE shp END AS rev_rtrn_date, o.o_orderdate + INTERVAL 60 DAY AS rev_due_date
FROM (SELECT l_orderkey AS prop_id, l_suppkey AS revr_id, min(l_partkey) AS k, min(l_partkey) + 3 * min(l_orderkey) AS m, max(l_shipdate) AS shp
      FROM lineitem GROUP BY l_orderkey, l_suppkey) g JOIN orders o ON o.o_orderkey = g.prop_id
""",
    "v_panl_prop": """
SELECT DISTINCT concat('P', lpad(replace(p.p_brand, 'Brand#', ''), 2, '0')) AS panl_id, l.l_orderkey AS prop_id FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey WHERE l.l_orderkey % 20 <> 19
""",
    "v_panl_revr": """
SELECT DISTINCT concat('P', lpad(replace(p.p_brand, 'Brand#', ''), 2, '0')) AS panl_id, l.l_suppkey AS revr_id FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey WHERE l.l_suppkey % 9 <> 4
""",
    "v_panl": """
SELECT concat('P', lpad(replace(p.p_brand, 'Brand#', ''), 2, '0')) AS panl_id, p.p_brand AS panl_name, min(l.l_shipdate) AS panl_bgn_date,
  min(l.l_shipdate) + INTERVAL 2 DAY AS panl_end_date FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY p.p_brand
""",
    "v_rec": """
SELECT panl_id, prop_id, CASE WHEN prop_id % 9 = 0 THEN NULL ELSE 1 + prop_id % 5 END AS rcom_seq_num,
  CASE WHEN prop_id % 9 = 0 THEN NULL ELSE CASE prop_id % 5 WHEN 0 THEN 'HC' WHEN 1 THEN 'C' WHEN 2 THEN 'LC' WHEN 3 THEN 'NC' ELSE 'NDP' END END AS rcom_abbr,
  CASE WHEN prop_id % 3 = 0 THEN NULL ELSE 1 + prop_id % 30 END AS prop_ordr,
  CASE WHEN prop_id % 8 = 0 THEN 'Y' ELSE 'N' END AS panl_summ_rlse_flag, CASE WHEN prop_id % 31 = 0 THEN 'Y' ELSE 'N' END AS panl_summ_unrl_flag
FROM v_panl_prop WHERE prop_id % 10 <> 3
""",
    "v_confl": """
SELECT pr.panl_id, r.revr_id, r.prop_id FROM v_rev r JOIN v_panl_prop pp ON pp.prop_id = r.prop_id
JOIN v_panl_revr pr ON pr.panl_id = pp.panl_id AND pr.revr_id = r.revr_id WHERE r.rev_stts_code = 'C'
""",
    "v_budg": """
SELECT l_orderkey AS prop_id, l_partkey % 3 AS revn_num, l_linenumber AS budg_seq_yr,
  CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(12, 2))), 0) AS DOUBLE) AS budg_tot_dol,
  CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_discount AS DECIMAL(12, 2))) FILTER (WHERE l_returnflag = 'A'), 0) AS DOUBLE) AS sub_ctr_dol,
  CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_tax AS DECIMAL(12, 2))) FILTER (WHERE l_returnflag = 'N'), 0) AS DOUBLE) AS cnsl_dol,
  CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_discount AS DECIMAL(12, 2))) FILTER (WHERE l_linenumber % 2 = 0), 0) AS DOUBLE) AS cptr_serv_dol,
  CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_tax AS DECIMAL(12, 2))), 0) AS DOUBLE) AS frgn_trav_dol,
  CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(12, 2))) FILTER (WHERE l_linenumber % 3 = 0), 0) AS DOUBLE) AS pdoc_grnt_dol,
  CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_tax AS DECIMAL(12, 2))) FILTER (WHERE l_linestatus = 'F' AND l_returnflag = 'R'), 0) AS DOUBLE) AS part_dol,
  CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(12, 2))) FILTER (WHERE l_linestatus = 'F'), 0) AS DOUBLE) AS part_cnt,
  CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(12, 2))) FILTER (WHERE l_returnflag = 'R'), 0) AS DOUBLE) AS grad_pers_tot_cnt,
  CAST(coalesce(sum(1) FILTER (WHERE l_returnflag = 'A'), 0) AS DOUBLE) AS sr_pers_cnt,
  CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(12, 2))) FILTER (WHERE l_linenumber % 3 = 0), 0) AS DOUBLE) AS sr_summ_mnth_cnt,
  CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(12, 2))) FILTER (WHERE l_linenumber % 3 = 1), 0) AS DOUBLE) AS sr_acad_mnth_cnt,
  CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(12, 2))) FILTER (WHERE l_linenumber % 3 = 2), 0) AS DOUBLE) AS sr_cal_mnth_cnt
FROM lineitem GROUP BY l_orderkey, l_partkey % 3, l_linenumber
""",
    "v_splt": """
SELECT l_orderkey AS prop_id, CAST(year(l_shipdate) AS INT) AS budg_yr, CAST(l_linenumber AS STRING) AS splt_id, sum(l_extendedprice) AS budg_splt_tot_dol,
  min(p_type) AS pgm_ele_code, max(l_shipdate) AS frwd_date, concat(CAST(min(l_partkey) % 5 + 10 AS STRING), lpad(CAST(min(l_partkey) % 25 + 1 AS STRING), 6, '0')) AS org_code,
  concat('po', CAST(min(l_partkey) % 13 AS STRING)) AS pm_ibm_logn_id, CASE min(l_partkey) % 4 WHEN 0 THEN '2500' WHEN 1 THEN '4100' ELSE '4110' END AS obj_clas_code, CASE WHEN max(l_linestatus) = 'F' THEN l_orderkey END AS awd_id FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey, year(l_shipdate), l_linenumber
""",
    "v_splt_code": """
SELECT DISTINCT l_orderkey AS prop_id, CAST(year(l_shipdate) AS INT) AS budg_yr, CAST(l_linenumber AS STRING) AS splt_id, lpad(CAST(p_size AS STRING), 4, '0') AS pgm_ref_code
FROM lineitem JOIN part ON p_partkey = l_partkey
""",
    "v_cost": """
SELECT l_orderkey AS prop_id, l_suppkey % 3 AS perf_inst_id, l_partkey % 2 AS revn_num,
  CASE l_linenumber % 4 WHEN 0 THEN 'budg' WHEN 1 THEN 'senior' WHEN 2 THEN 'equip' ELSE 'indirect' END AS src,
  CASE WHEN l_linenumber % 4 = 0 AND l_suppkey % 3 = 0 THEN l_extendedprice * l_discount ELSE NULL END AS sub_ctr_req_dol,
  l_extendedprice AS amount, l_tax * 100 AS rate FROM lineitem
""",
    "v_awd_pi": """
SELECT o_orderkey AS awd_id, o_custkey AS pi_id, '1' AS proj_role_code, o_orderdate AS awd_eff_date, o_orderdate + INTERVAL 1000 DAY AS awd_exp_date,
  CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate + INTERVAL 30 DAY ELSE NULL END AS end_date FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT c.prop_id, c.pi_id, '2', o.o_orderdate, o.o_orderdate + INTERVAL 1000 DAY, NULL FROM v_copi c JOIN orders o ON o.o_orderkey = c.prop_id WHERE o.o_orderstatus = 'F'
""",
    "v_chg": """
SELECT user_id AS awd_id, event_id, ts AS awd_chg_date, event_type AS to_org,
  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_org FROM events
""",
    "v_idlist": """
SELECT o_orderkey AS prop_id FROM orders WHERE o_orderkey % 97 = 5 UNION ALL SELECT -1 - o_orderkey FROM orders WHERE o_orderkey % 997 = 5
""",
    "v_text": """
SELECT doc_id AS prop_id, CASE doc_id % 3 WHEN 0 THEN 'Abstr' WHEN 1 THEN 'POCmnt' ELSE 'RA' END AS doc_type, source AS author, text FROM documents
UNION ALL SELECT conv_id, 'xDiaryNt', role, text FROM conversations
""",
    "v_inst": """
SELECT n_nationkey AS inst_id, n_name AS inst_shrt_name, concat('S', CAST(n_regionkey AS STRING)) AS st_code FROM nation
""",
    "v_ctry": """
SELECT lpad(CAST(n_nationkey AS STRING), 4, '0') AS ctry_code, n_name AS ctry_name FROM nation
""",
    "v_senior": """
SELECT DISTINCT l_orderkey AS prop_id, c_name AS last_name, concat('F', CAST(c_custkey % 10 AS STRING)) AS frst_name, c_nationkey AS inst_id
FROM lineitem JOIN customer ON c_custkey = l_suppkey WHERE l_linenumber IN (1, 2)
""",
    "v_subpi": """
SELECT DISTINCT l_orderkey AS prop_id, c_name AS last_name, concat('F', CAST(c_custkey % 10 AS STRING)) AS frst_name, c_nationkey AS inst_id
FROM lineitem JOIN customer ON c_custkey = l_suppkey WHERE l_linenumber IN (2, 3)
""",
    "v_revr_mail": """
SELECT s_suppkey AS revr_id, CASE WHEN s_suppkey % 4 = 3 THEN 'P' ELSE 'E' END AS addr_lne_type_code, concat(lower(s_name), '@review.example.org') AS revr_addr_txt
FROM supplier WHERE s_suppkey % 4 <> 1
""",
    "v_subm": """
SELECT o_orderkey AS prop_id, o_orderkey + 5000000 AS temp_prop_id FROM orders
""",
    "v_route": """
SELECT DISTINCT l_orderkey + 5000000 AS temp_prop_id, concat('R', CAST(l_linenumber AS STRING)) AS code, 8 - l_linenumber AS sequence FROM lineitem
""",
    "v_item": """
SELECT prop_id + 5000000 AS temp_prop_id, prop_atr_code AS spcl_item_code, CASE WHEN CAST(prop_atr_code AS INT) % 6 = 5 THEN DATE '2000-01-01' END AS end_date FROM v_atr
""",
    "v_covr": """
SELECT o_orderkey + 5000000 AS temp_prop_id, CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate + INTERVAL 10 DAY END AS hum_date, CASE WHEN o_orderkey % 6 = 1 THEN 'Y' ELSE 'N' END AS humn_date_pend_flag,
  CASE WHEN o_orderkey % 9 = 0 THEN o_orderdate + INTERVAL 20 DAY END AS vert_date, CASE WHEN o_orderkey % 9 = 4 THEN 'Y' ELSE 'N' END AS vrtb_date_pend_flag,
  CASE WHEN o_orderkey % 8 = 5 AND o_orderkey % 40 <> 5 THEN o_orderkey - 8 END AS prev_awd_id FROM orders
""",
    "v_rev_txt": """
SELECT doc_id AS prop_id, length(text) AS text_len FROM documents
""",
    "v_awd": """
SELECT o_orderkey AS awd_id, CAST(o_custkey % 25 AS INT) AS inst_id, CASE WHEN o_orderkey % 3 = 0 THEN '90' ELSE '80' END AS awd_stts_code, o_totalprice AS tot_intn_awd_amt,
  o_orderdate AS awd_eff_date, o_orderdate + INTERVAL 1000 DAY AS awd_exp_date, concat('po', CAST(o_orderkey % 7 AS STRING)) AS pm_ibm_logn_id,
  concat(CAST(o_orderkey % 5 + 10 AS STRING), '000001') AS org_code, o_orderpriority AS pgm_ele_code FROM orders WHERE o_orderstatus = 'F'
""",
    "v_oblg": """
SELECT l_orderkey AS oblg_id, l_extendedprice AS oblg_amt, CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE 0 END AS cuml_xpnd_amt, l_shipdate AS last_pymt_date FROM lineitem
""",
    "v_doc": """
SELECT doc_id + 5000000 AS temp_prop_id, kind, CAST(n_chars // (i * 300) AS INT) AS pdf_page_cnt,
  CASE WHEN (doc_id + i) % 5 = 0 THEN ' ' WHEN (doc_id + i) % 5 <> 1 THEN source END AS path_name, CASE WHEN (doc_id + i) % 7 <> 0 THEN n_chars END AS text_len
FROM documents CROSS JOIN (VALUES ('proj_desc', 1), ('bibl', 2), ('dmp_plan', 3), ('ment_plan', 4), ('budg_expl', 5), ('supp', 6)) AS k(kind, i) WHERE (doc_id + i) % 4 <> 0
""",
    "v_prj": """
SELECT CASE WHEN lead_prop_id IS NULL THEN 'I' WHEN lead_prop_id <> prop_id THEN 'N' ELSE 'L' END AS "ILN", coalesce(lead_prop_id, prop_id) AS lead, v_prop.* FROM v_prop
""",
    "v_ra": """
SELECT doc_id AS prop_id, DATE '2001-01-01' + INTERVAL 1 DAY * CAST(n_chars % 1000 AS INT) AS last_updt_tmsp FROM documents
""",
    "v_upld": """
SELECT user_id AS prop_id, CASE WHEN event_type = 'click' THEN '034' ELSE '099' END AS upload_type_code, ts AS last_updt_tmsp FROM events
""",
    "v_sugg": """
SELECT doc_id + 5000000 AS temp_prop_id, text AS revr_want, concat(source, ' ', lang) AS revr_dont_want FROM documents
""",
    "v_log": """
SELECT awd_id, awd_id - awd_id % 2 AS last_prop_id, awd_chg_date, concat(CAST(10 + event_id % 5 AS STRING), lpad(CAST(event_id % 25 + 1 AS STRING), 6, '0')) AS org_code,
  (['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])[event_id % 5 + 1] AS pgm_ele_code, concat('po', CAST(event_id % 13 AS STRING)) AS pm_ibm_logn_id FROM v_chg
""",
    "v_own": """
SELECT awd_id * 2 AS prop_id, CASE WHEN event_id % 3 = 0 THEN 9 ELSE 1 END AS ownr_stts_code, awd_chg_date AS crtd_date, from_org, to_org,
  (['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])[event_id % 3 + 1] AS from_pgm, (['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])[event_id % 5 + 1] AS to_pgm, concat('po', CAST(event_id % 4 AS STRING)) AS from_lan_id, concat('po', CAST(event_id % 6 AS STRING)) AS to_lan_id,
  CASE WHEN event_id % 6 = 0 THEN concat('event ', CAST(event_id AS STRING)) END AS note FROM v_chg
""",
}


def with_views(sql: str) -> str:
    """Prefix a query with the views it names, and the views those need."""
    body = sql.strip().rstrip(";")
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bv_[a-z_]+", text)):
            if name in VIEWS and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
