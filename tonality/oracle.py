"""DuckDB SQL equal to each registered query (same keys, same column names).

The driver registers the parquet tables as views; these strings only read them.
Building blocks are common table expressions assembled per key.
"""

from __future__ import annotations

# Fixed values shared with the Spark side (see functions/text.py and sources/fixtures.py).
SPLIT_RX = r"'[ \t\n\r\f]+'"
STRIP_RX = r"""'[0-9.:,"''()\[\]|/?!;]+'"""
INVALID = "'Invalid input. Please try again.'"


def tokens_cte(name: str, source: str, id_col: str = "doc_id", text_col: str = "text") -> str:
    return (
        f"{name}_p AS (SELECT {id_col}, regexp_split_to_array({text_col}, {SPLIT_RX}) AS arr FROM {source}),\n"
        f"{name}_u AS (SELECT {id_col}, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS pos, "
        f"unnest(arr) AS piece FROM {name}_p),\n"
        f"{name}_n AS (SELECT {id_col}, pos, lower(regexp_replace(piece, {STRIP_RX}, '', 'g')) AS word "
        f"FROM {name}_u),\n"
        f"{name} AS (SELECT {id_col}, pos, word FROM {name}_n WHERE word <> '')")


REVIEWS = """reviews AS (
  SELECT d.doc_id, d.text,
         CASE WHEN d.doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
         CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS sentiment,
         CASE WHEN l.quality = 1 THEN 0 ELSE 1 END AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

WORD_VECTORS = """wv_counts AS (SELECT word, count(*) AS n FROM tokens GROUP BY word),
wv_ranked AS (SELECT word, row_number() OVER (ORDER BY n DESC, word ASC) - 1 AS rnk FROM wv_counts),
word_vectors AS (SELECT r.word, e.vec_id, e.embedding AS vector
                 FROM wv_ranked r JOIN embeddings e ON e.vec_id = r.rnk)"""


def known_cte(name: str, toks: str, id_col: str = "doc_id", max_len: int | None = None) -> str:
    limit = f" WHERE t <= {max_len}" if max_len else ""
    return (f"{name}_all AS (SELECT {id_col}, pos, word, "
            f"row_number() OVER (PARTITION BY {id_col} ORDER BY pos) AS t FROM {toks} "
            f"WHERE word IN (SELECT word FROM word_vectors)),\n"
            f"{name} AS (SELECT * FROM {name}_all{limit})")


def pooled_cte(trunc: str, id_col: str = "doc_id", prefix: str = "") -> str:
    """<prefix>pooled_long(id, i, m), <prefix>pooled(id, pooled), <prefix>doc_n(id, n)."""
    p = prefix
    return (f"{p}seqv AS (SELECT k.{id_col}, k.t, w.vector FROM {trunc} k JOIN word_vectors w ON k.word = w.word),\n"
            f"{p}pooled_long AS (SELECT {id_col}, i, avg(CAST(v AS DOUBLE)) AS m FROM "
            f"(SELECT {id_col}, unnest(vector) AS v, generate_subscripts(vector, 1) AS i FROM {p}seqv) "
            f"GROUP BY {id_col}, i),\n"
            f"{p}pooled AS (SELECT {id_col}, list(m ORDER BY i) AS pooled FROM {p}pooled_long GROUP BY {id_col}),\n"
            f"{p}doc_n AS (SELECT {id_col}, count(*) AS n FROM {trunc} GROUP BY {id_col})")


# Centroid model: trained on train-split labelled documents with a known word.
CENTROID = """cls_mean AS (SELECT r.label, p.i, avg(p.m) AS mu FROM pooled_long p JOIN reviews r ON p.doc_id = r.doc_id
                 WHERE r.split = 'train' GROUP BY r.label, p.i),
wts AS (SELECT a.i, a.mu - b.mu AS w, (a.mu + b.mu) / 2 AS mid FROM cls_mean a JOIN cls_mean b
        ON a.i = b.i AND a.label = 0 AND b.label = 1),
bias AS (SELECT -sum(w * mid) AS b FROM wts)"""


def logit_cte(name: str, long: str, id_col: str = "doc_id") -> str:
    return (f"{name} AS (SELECT pl.{id_col}, sum(pl.m * w.w) + (SELECT b FROM bias) AS z "
            f"FROM {long} pl JOIN wts w ON pl.i = w.i GROUP BY pl.{id_col})")


SCORED = """lp AS (SELECT r.doc_id, r.split, r.sentiment, r.label, coalesce(dn.n, 0) AS n
       FROM reviews r LEFT JOIN doc_n dn ON r.doc_id = dn.doc_id),
zs AS (SELECT pl.doc_id, sum(pl.m * w.w) + (SELECT b FROM bias) AS z
       FROM pooled_long pl JOIN wts w ON pl.i = w.i GROUP BY pl.doc_id),
scored0 AS (SELECT lp.*, zs.z, round(1 / (1 + exp(-z)), 6) AS score_pos, round(1 / (1 + exp(z)), 6) AS score_neg
            FROM lp LEFT JOIN zs ON lp.doc_id = zs.doc_id),
scored AS (SELECT *, CASE WHEN z IS NULL THEN NULL
                          WHEN 1 / (1 + exp(-z)) >= 1 / (1 + exp(z)) THEN 'Positive' ELSE 'Negative' END AS verdict
           FROM scored0)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = [tokens_cte("tokens", "documents"), WORD_VECTORS]
TRUNC = BASE + [known_cte("trunc", "tokens", max_len=256)]
MODEL = TRUNC + [REVIEWS, pooled_cte("trunc"), CENTROID, SCORED]

SQL: dict[str, str] = {}

SQL["tokenize"] = with_(*BASE[:1]) + "SELECT doc_id, pos, word FROM tokens"

SQL["word_vectors"] = with_(*BASE) + \
    "SELECT word, vec_id, CAST(vector AS DOUBLE[]) AS vector FROM word_vectors"

SQL["known_tokens"] = with_(*BASE, known_cte("known", "tokens")) + \
    "SELECT doc_id, pos, word, t FROM known"

SQL["oov_words"] = with_(*BASE) + \
    "SELECT word, count(*) AS n FROM tokens WHERE word NOT IN (SELECT word FROM word_vectors) GROUP BY word"

SQL["known_token_counts"] = with_(*BASE) + """
SELECT d.doc_id, coalesce(c.n_tokens, 0) AS n_tokens, coalesce(c.n_known, 0) AS n_known
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_tokens,
         count(*) FILTER (WHERE word IN (SELECT word FROM word_vectors)) AS n_known
  FROM tokens GROUP BY doc_id) c ON d.doc_id = c.doc_id"""

SQL["truncated_sequences"] = with_(*TRUNC) + \
    "SELECT doc_id, count(*) AS n, list(word ORDER BY t) AS words FROM trunc GROUP BY doc_id"

SQL["sequence_vectors"] = with_(*TRUNC) + """
SELECT k.doc_id, k.t, k.word, CAST(w.vector AS DOUBLE[]) AS vector
FROM trunc k JOIN word_vectors w ON k.word = w.word"""

SQL["token_vector_lookup"] = with_(*BASE) + """
SELECT k.doc_id, k.pos, k.word, CAST(w.vector AS DOUBLE[]) AS vector
FROM tokens k LEFT JOIN word_vectors w ON k.word = w.word"""

SQL["pooled_vectors"] = with_(*TRUNC, pooled_cte("trunc")) + """
SELECT p.doc_id, n.n, list_transform(p.pooled, lambda x: round(x, 6)) AS pooled
FROM pooled p JOIN doc_n n ON p.doc_id = n.doc_id"""

SQL["vector_dimension"] = with_(*BASE) + """
SELECT min(len(vector)) AS min_dim, max(len(vector)) AS max_dim, count(*) AS n_words FROM word_vectors"""

SQL["linear_scores"] = with_(*MODEL) + """
SELECT doc_id, split, sentiment AS actual, n, score_pos, score_neg, verdict AS predicted FROM scored"""

CONFUSION = """cm AS (
  SELECT a.actual, a.predicted, count(s.doc_id) AS n
  FROM (VALUES ('positive', 'positive'), ('positive', 'negative'),
               ('negative', 'positive'), ('negative', 'negative')) a(actual, predicted)
  LEFT JOIN (SELECT * FROM scored WHERE split = 'test' AND verdict IS NOT NULL) s
    ON s.sentiment = a.actual AND lower(s.verdict) = a.predicted
  GROUP BY a.actual, a.predicted)"""

SQL["confusion_matrix"] = with_(*MODEL, CONFUSION) + "SELECT actual, predicted, n FROM cm"

SQL["classification_metrics"] = with_(*MODEL, CONFUSION) + """,
per AS (
  SELECT 'positive' AS class,
         sum(CASE WHEN actual = 'positive' AND predicted = 'positive' THEN n ELSE 0 END) AS tp,
         sum(CASE WHEN actual <> 'positive' AND predicted = 'positive' THEN n ELSE 0 END) AS fp,
         sum(CASE WHEN actual = 'positive' AND predicted <> 'positive' THEN n ELSE 0 END) AS fn
  FROM cm
  UNION ALL
  SELECT 'negative' AS class,
         sum(CASE WHEN actual = 'negative' AND predicted = 'negative' THEN n ELSE 0 END) AS tp,
         sum(CASE WHEN actual <> 'negative' AND predicted = 'negative' THEN n ELSE 0 END) AS fp,
         sum(CASE WHEN actual = 'negative' AND predicted <> 'negative' THEN n ELSE 0 END) AS fn
  FROM cm),
m AS (
  SELECT class,
         CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) END AS precision,
         CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) END AS recall,
         tp + fn AS support FROM per),
m2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) END AS f1 FROM m),
acc AS (SELECT CASE WHEN sum(n) > 0 THEN sum(CASE WHEN actual = predicted THEN n ELSE 0 END)::DOUBLE / sum(n) END AS accuracy,
               sum(n) AS total FROM cm),
allrows AS (
  SELECT class, precision, recall, f1, support FROM m2
  UNION ALL
  SELECT 'macro', avg(precision), avg(recall), avg(f1), (SELECT total FROM acc) FROM m2)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support, round((SELECT accuracy FROM acc), 6) AS accuracy
FROM allrows"""

SQL["cross_entropy"] = with_(*MODEL) + """
SELECT split, count(*) AS n,
       round(avg(greatest(CASE WHEN label = 0 THEN -z ELSE z END, 0) + ln(1 + exp(-abs(z)))), 6) AS loss
FROM scored WHERE z IS NOT NULL GROUP BY split"""

# ---------------------------------------------------------------- dataset assembly

INTERLEAVE = """iv0 AS (SELECT doc_id, split, sentiment, label,
               row_number() OVER (PARTITION BY split, label ORDER BY doc_id) - 1 AS rn FROM reviews),
sz AS (SELECT split, count(*) FILTER (WHERE label = 0) AS n_pos, count(*) FILTER (WHERE label = 1) AS n_neg,
              least(count(*) FILTER (WHERE label = 0), count(*) FILTER (WHERE label = 1)) AS m,
              count(*) AS total
       FROM reviews GROUP BY split),
iv AS (SELECT iv0.doc_id, iv0.split, iv0.sentiment, iv0.label,
              CASE WHEN rn < m THEN 2 * rn + label ELSE 2 * m + (rn - m) END AS position
       FROM iv0 JOIN sz ON iv0.split = sz.split),
mb AS (SELECT *, position // 64 AS batch_id, position % 64 AS row_in_batch FROM iv)"""

DATASET = [REVIEWS, INTERLEAVE]

SQL["split_counts"] = with_(REVIEWS) + \
    "SELECT split, sentiment, count(*) AS n_docs FROM reviews GROUP BY split, sentiment"

SQL["class_union"] = with_(REVIEWS) + "SELECT doc_id, split, sentiment FROM reviews"

SQL["interleave"] = with_(*DATASET) + \
    "SELECT doc_id, split, sentiment, CAST(label AS BIGINT) AS label, position, position % 2 = 0 AS parity_positive FROM iv"

SQL["minibatches"] = with_(*DATASET) + \
    "SELECT doc_id, split, position, batch_id, row_in_batch FROM mb"

LABELLED_KNOWN = [tokens_cte("rtok", "reviews"), known_cte("rknown", "rtok")]

SQL["batch_lengths"] = with_(*BASE, *DATASET, *LABELLED_KNOWN) + """
SELECT mb.split, mb.batch_id, count(*) AS n_docs, max(coalesce(c.n, 0)) AS max_known,
       least(max(coalesce(c.n, 0)), 256) AS max_len
FROM mb LEFT JOIN (SELECT doc_id, count(*) AS n FROM rknown GROUP BY doc_id) c ON mb.doc_id = c.doc_id
GROUP BY mb.split, mb.batch_id"""

SQL["label_steps"] = with_(*BASE, REVIEWS, tokens_cte("rtok", "reviews"),
                           known_cte("rtrunc", "rtok", max_len=256)) + """
SELECT doc_id, t, word, t = max(t) OVER (PARTITION BY doc_id) AS is_label_step FROM rtrunc"""

SQL["doc_at_position"] = with_(*DATASET) + """
SELECT iv.split, iv.position, iv.doc_id, iv.sentiment, r.text FROM iv JOIN reviews r ON iv.doc_id = r.doc_id"""

SQL["minibatch_fetch"] = with_(*DATASET) + """
SELECT mb.split, mb.batch_id, count(*) AS n_rows, min(position) AS first_position, max(position) AS last_position,
       max(position) + 1 < max(sz.total) AS has_next
FROM mb JOIN sz ON mb.split = sz.split GROUP BY mb.split, mb.batch_id"""

SQL["epoch_schedule"] = with_(*DATASET) + """,
per AS (SELECT split, batch_id, count(*) AS n_docs FROM mb WHERE split = 'train' GROUP BY split, batch_id),
nb AS (SELECT split, count(*) AS n_batches FROM per GROUP BY split)
SELECT epoch, split, batch_id, n_docs, (epoch - 1) * n_batches + batch_id AS step FROM (
  SELECT CAST(unnest(range(1, 2)) AS BIGINT) AS epoch, per.split, per.batch_id, per.n_docs, nb.n_batches
  FROM per JOIN nb ON per.split = nb.split)"""

SQL["label_onehot"] = with_(REVIEWS) + """
SELECT doc_id, CAST(label AS BIGINT) AS label,
       CASE WHEN label = 0 THEN [1.0, 0.0]::DOUBLE[] ELSE [0.0, 1.0]::DOUBLE[] END AS onehot FROM reviews"""

SQL["label_names"] = with_(REVIEWS) + """
SELECT CAST(n.label AS BIGINT) AS label, n.label_name, coalesce(c.n_docs, 0) AS n_docs
FROM (VALUES (0, 'positive'), (1, 'negative')) n(label, label_name)
LEFT JOIN (SELECT label, count(*) AS n_docs FROM reviews GROUP BY label) c ON n.label = c.label"""

# ---------------------------------------------------------------- arrays and tensors

MEMBERS = """rcount AS (SELECT doc_id, count(*) AS n_known FROM rknown GROUP BY doc_id),
members0 AS (SELECT mb.doc_id, mb.split, mb.batch_id, mb.row_in_batch, mb.label, coalesce(c.n_known, 0) AS n_known
             FROM mb LEFT JOIN rcount c ON mb.doc_id = c.doc_id),
members AS (SELECT *, least(n_known, 256) AS n,
                   least(max(n_known) OVER (PARTITION BY split, batch_id), 256) AS L FROM members0)"""

ARRAYS = [*BASE, *DATASET, *LABELLED_KNOWN, MEMBERS]

SQL["padded_sequences"] = with_(*ARRAYS) + """,
stepsum AS (SELECT k.doc_id, k.t, round(list_sum(list_transform(w.vector, lambda x: x::DOUBLE)), 6) AS s
            FROM rknown k JOIN word_vectors w ON k.word = w.word WHERE k.t <= 256),
grid AS (SELECT m.doc_id, unnest(range(1, m.L + 1)) AS t FROM members m),
lists AS (SELECT g.doc_id, list(coalesce(ss.s, 0.0) ORDER BY g.t) AS step_sums
          FROM grid g LEFT JOIN stepsum ss ON g.doc_id = ss.doc_id AND g.t = ss.t GROUP BY g.doc_id)
SELECT m.doc_id, m.split, m.batch_id, m.L, m.n, coalesce(l.step_sums, []::DOUBLE[]) AS step_sums
FROM members m LEFT JOIN lists l ON m.doc_id = l.doc_id"""

SQL["sequence_masks"] = with_(*ARRAYS) + """
SELECT doc_id, L, n,
       CAST(list_transform(range(L), lambda s: CASE WHEN s < n THEN 1 ELSE 0 END) AS BIGINT[]) AS feature_mask,
       CAST(list_transform(range(L), lambda s: CASE WHEN s = n - 1 THEN 1 ELSE 0 END) AS BIGINT[]) AS label_mask
FROM members"""

SQL["label_tensor"] = with_(*ARRAYS) + """
SELECT doc_id, L, n,
       list_transform(range(L), lambda s: CASE WHEN s = n - 1 THEN
           (CASE WHEN label = 0 THEN [1.0, 0.0]::DOUBLE[] ELSE [0.0, 1.0]::DOUBLE[] END)
           ELSE [0.0, 0.0]::DOUBLE[] END) AS labels
FROM members"""

SQL["sequence_transpose"] = with_(*TRUNC) + """,
long AS (SELECT k.doc_id, k.t, unnest(w.vector) AS v, generate_subscripts(w.vector, 1) AS i
         FROM trunc k JOIN word_vectors w ON k.word = w.word),
per AS (SELECT doc_id, i, round(sum(CAST(v AS DOUBLE)), 6) AS s, count(*) AS n_steps FROM long GROUP BY doc_id, i)
SELECT doc_id, count(*) AS n_dims, max(n_steps) AS n_steps, list(s ORDER BY i) AS dim_sums FROM per GROUP BY doc_id"""

SQL["inference_shape"] = with_(*BASE) + """,
c AS (SELECT d.doc_id, coalesce(x.n_tokens, 0) AS n_tokens, coalesce(x.n_known, 0) AS n_known
      FROM documents d LEFT JOIN (
        SELECT doc_id, count(*) AS n_tokens,
               count(*) FILTER (WHERE word IN (SELECT word FROM word_vectors)) AS n_known
        FROM tokens GROUP BY doc_id) x ON d.doc_id = x.doc_id)
SELECT doc_id, n_tokens, n_known, greatest(256, n_known) AS out_len, least(256, n_known) AS filled FROM c"""

SQL["last_step"] = with_(*ARRAYS, known_cte("trunc", "tokens", max_len=256),
                         pooled_cte("trunc"), CENTROID) + """,
stepz AS (SELECT k.doc_id, k.t, round(1 / (1 + exp(-(sum(CAST(v AS DOUBLE) * w.w) + (SELECT b FROM bias)))), 6) AS o
          FROM (SELECT k.doc_id, k.t, unnest(wv.vector) AS v, generate_subscripts(wv.vector, 1) AS i
                FROM rknown k JOIN word_vectors wv ON k.word = wv.word WHERE k.t <= 256) k
          JOIN wts w ON k.i = w.i GROUP BY k.doc_id, k.t),
padz AS (SELECT round(1 / (1 + exp(-(SELECT b FROM bias))), 6) AS o)
SELECT m.doc_id, m.L, m.n,
       CASE WHEN m.L = 0 THEN NULL WHEN m.n = m.L THEN (SELECT o FROM stepz s WHERE s.doc_id = m.doc_id AND s.t = m.n)
            ELSE (SELECT o FROM padz) END AS last_padded,
       CASE WHEN m.n > 0 THEN (SELECT o FROM stepz s WHERE s.doc_id = m.doc_id AND s.t = m.n) END AS last_real
FROM members m"""

# ---------------------------------------------------------------- projections and batch scoring

from .sources.fixtures import EMAIL_COLUMNS  # noqa: E402

_FILLED = {"Id": "CAST(conv_id AS DOUBLE)", "MetadataSubject": "role",
           "ExtractedReleaseInPartOrFull": "role", "ExtractedBodyText": "text",
           "SenderPersonId": "CAST(turn AS DOUBLE)"}
_SQLTYPE = {"double": "DOUBLE", "string": "VARCHAR", "timestamp": "TIMESTAMP"}
MESSAGES27 = "msgs27 AS (SELECT " + ", ".join(
    f"{_FILLED.get(n, 'NULL::' + _SQLTYPE[t])} AS {n}" for n, t in EMAIL_COLUMNS) + " FROM conversations)"

MSGS = """msgs AS (SELECT CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS msg_key,
                concat_ws(' ', coalesce(role, ''), coalesce(text, '')) AS raw_email FROM conversations)"""


def score_select(src: str, key: str, text: str, n_tab: str, z_tab: str, extra: str = "") -> str:
    """Final projection of the shared scoring path (status, verdict, echoed output)."""
    return f"""
, sc0 AS (SELECT s.{key}, s.{text}, coalesce(nt.n, 0) AS n_known, nt.n AS n_raw, zz.z,
                round(1 / (1 + exp(-zz.z)), 6) AS score_pos, round(1 / (1 + exp(zz.z)), 6) AS score_neg
         FROM {src} s LEFT JOIN {n_tab} nt ON s.{key} = nt.{key} LEFT JOIN {z_tab} zz ON s.{key} = zz.{key}),
sc AS (SELECT *, CASE WHEN z IS NULL THEN NULL
                      WHEN 1 / (1 + exp(-z)) >= 1 / (1 + exp(z)) THEN 'Positive' ELSE 'Negative' END AS sentiment,
              CASE WHEN {text} IS NULL OR n_raw IS NULL THEN {INVALID} ELSE 'OK' END AS status
       FROM sc0),
sc2 AS (SELECT *, CASE WHEN score_pos IS NULL OR score_neg IS NULL THEN {INVALID}
                       ELSE 'Sentiment: ' || sentiment || ' [p(positive)=' || printf('%.6f', score_pos)
                            || ' p(negative)=' || printf('%.6f', score_neg) || ']' END AS verdict_line
        FROM sc),
scored_texts AS (SELECT *, coalesce({text}, '') || chr(10) || verdict_line AS output FROM sc2)
"""


DOC_SCORES = MODEL + [logit_cte("dz", "pooled_long")]

SQL["project_messages"] = with_(MESSAGES27) + "SELECT MetadataSubject, ExtractedBodyText FROM msgs27"

SQL["categorical_code"] = """
SELECT conv_id, turn, role,
       CAST(CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 END AS BIGINT) AS role_code
FROM conversations"""

SQL["typed_columns"] = with_(MESSAGES27) + "SELECT * FROM msgs27"

SQL["concat_message"] = with_(MSGS) + "SELECT msg_key, raw_email FROM msgs"

SQL["email_sentiment"] = with_(*MODEL, MSGS, tokens_cte("mtok", "msgs", "msg_key", "raw_email"),
                               known_cte("mtrunc", "mtok", "msg_key", 256),
                               pooled_cte("mtrunc", "msg_key", "m_"),
                               logit_cte("mz", "m_pooled_long", "msg_key")) + \
    score_select("msgs", "msg_key", "raw_email", "m_doc_n", "mz") + """
SELECT msg_key, raw_email, n_known, score_pos, score_neg, sentiment, status, output FROM scored_texts"""

SQL["score_adhoc"] = with_(*DOC_SCORES) + score_select("documents", "doc_id", "text", "doc_n", "dz") + """
SELECT doc_id, text, score_pos, score_neg, sentiment, status, output FROM scored_texts"""

SQL["score_status"] = with_(*DOC_SCORES) + score_select("documents", "doc_id", "text", "doc_n", "dz") + """
SELECT doc_id, n_known, status FROM scored_texts"""

SQL["verdict_text"] = with_(*DOC_SCORES) + score_select("reviews", "doc_id", "text", "doc_n", "dz") + """
SELECT doc_id, sentiment, verdict_line, output FROM scored_texts"""

# ---------------------------------------------------------------- sources and sinks (round trips)

SQL["corpus_scan"] = with_(REVIEWS) + "SELECT doc_id, text, split, sentiment FROM reviews"

SQL["text_file_scan"] = "SELECT doc_id, text FROM documents"

SQL["email_csv_scan"] = with_(MESSAGES27) + "SELECT * FROM msgs27"

SQL["gzip_scan"] = with_(*BASE) + "SELECT word, CAST(vector AS DOUBLE[]) AS vector FROM word_vectors"

SQL["binary_vectors"] = SQL["word_vectors"]

SQL["archive_members"] = with_(REVIEWS) + """
SELECT 'corpus/' || split || '/' || CASE WHEN label = 0 THEN 'pos' ELSE 'neg' END || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS member,
       doc_id, split, sentiment, text, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes
FROM reviews"""

SQL["materialize_once"] = with_(REVIEWS) + "SELECT doc_id, text, split, sentiment FROM reviews"

SQL["stream_scores"] = with_(*DOC_SCORES) + score_select("documents", "doc_id", "text", "doc_n", "dz") + """
SELECT doc_id, n_known, score_pos, score_neg, sentiment, status FROM scored_texts"""

SQL["training_dataset"] = with_(*ARRAYS) + """,
dims AS (SELECT max(len(vector)) AS d FROM word_vectors),
grid AS (SELECT m.doc_id, m.n, m.label, unnest(range(1, m.L + 1)) AS t FROM members m),
steps AS (
  SELECT g.doc_id, g.t,
         coalesce(CAST(w.vector AS DOUBLE[]), list_transform(range((SELECT d FROM dims)), lambda i: 0.0)) AS v,
         CASE WHEN g.t = g.n THEN (CASE WHEN g.label = 0 THEN [1.0, 0.0]::DOUBLE[] ELSE [0.0, 1.0]::DOUBLE[] END)
              ELSE [0.0, 0.0]::DOUBLE[] END AS y,
         CAST(CASE WHEN g.t <= g.n THEN 1 ELSE 0 END AS BIGINT) AS fm,
         CAST(CASE WHEN g.t = g.n THEN 1 ELSE 0 END AS BIGINT) AS lm
  FROM grid g
  LEFT JOIN rknown k ON k.doc_id = g.doc_id AND k.t = g.t
  LEFT JOIN word_vectors w ON k.word = w.word),
per_doc AS (SELECT doc_id, list(v ORDER BY t) AS f, list(y ORDER BY t) AS l,
                   list(fm ORDER BY t) AS fmask, list(lm ORDER BY t) AS lmask
            FROM steps GROUP BY doc_id),
docs AS (SELECT m.split, m.batch_id, m.row_in_batch,
                coalesce(p.f, []::DOUBLE[][]) AS f, coalesce(p.l, []::DOUBLE[][]) AS l,
                coalesce(p.fmask, []::BIGINT[]) AS fmask, coalesce(p.lmask, []::BIGINT[]) AS lmask
         FROM members m LEFT JOIN per_doc p ON m.doc_id = p.doc_id)
SELECT split, batch_id, count(*) AS n_docs,
       list(f ORDER BY row_in_batch) AS features, list(l ORDER BY row_in_batch) AS labels,
       list(fmask ORDER BY row_in_batch) AS features_mask, list(lmask ORDER BY row_in_batch) AS labels_mask
FROM docs GROUP BY split, batch_id"""


# ---------------------------------------------------------------- scoring-time tensor, training by the configured rule


def _inference_sql(steps: str, filled: str) -> str:
    return with_(*BASE, known_cte("known", "tokens")) + f""",
c AS (SELECT d.doc_id, coalesce(x.n_tokens, 0) AS n_tokens, coalesce(x.n_known, 0) AS n_known
      FROM documents d LEFT JOIN (
        SELECT doc_id, count(*) AS n_tokens,
               count(*) FILTER (WHERE word IN (SELECT word FROM word_vectors)) AS n_known
        FROM tokens GROUP BY doc_id) x ON d.doc_id = x.doc_id),
steps AS ({steps}),
sums AS (SELECT s.doc_id, s.t, list_sum(list_transform(w.vector, lambda v: CAST(v AS DOUBLE))) AS total
         FROM steps s JOIN word_vectors w ON s.word = w.word WHERE s.t <= 256),
grid AS (SELECT doc_id, unnest(range(1, greatest(256, n_known) + 1)) AS t FROM c),
per AS (SELECT g.doc_id, list(round(coalesce(s.total, 0.0::DOUBLE), 6) ORDER BY g.t) AS step_sums
        FROM grid g LEFT JOIN sums s ON g.doc_id = s.doc_id AND g.t = s.t GROUP BY g.doc_id)
SELECT c.doc_id, c.n_known, greatest(256, c.n_known) AS out_len, least(256, {filled}) AS filled,
       greatest(256, c.n_known) AS n_steps, p.step_sums
FROM c JOIN per p ON c.doc_id = p.doc_id"""


SQL["inference_tensor"] = _inference_sql("SELECT doc_id, t, word FROM known", "c.n_known")

SQL["inference_tensor_all"] = _inference_sql(
    "SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS t, word FROM tokens", "c.n_tokens")

# Adam with clipping and L2 as a recursion over (step, parameter); parameter 0 is the bias,
# whose input is 1.  A document's z is a window sum, a parameter's gradient a group mean.
_ADAM_LR, _ADAM_L2, _ADAM_CLIP, _B1, _B2, _EPS = "0.02", "0.00001", "1.0", "0.9", "0.999", "0.00000001"


def _adam_ctes(steps: int) -> str:
    f = "::DOUBLE"
    return f"""tr AS (SELECT r.doc_id, CASE WHEN r.label = 0 THEN 1 ELSE 0 END AS pos
       FROM reviews r JOIN doc_n n ON r.doc_id = n.doc_id WHERE r.split = 'train'),
x AS MATERIALIZED (SELECT p.doc_id, CAST(p.i AS BIGINT) AS i, p.m AS x, t.pos FROM pooled_long p JOIN tr t ON p.doc_id = t.doc_id
      UNION ALL SELECT doc_id, 0, 1.0{f}, pos FROM tr),
adam(step, i, u, m, v, loss, n_docs) AS (
  SELECT 0, i, 0.0{f}, 0.0{f}, 0.0{f}, 0.0{f}, 0::BIGINT FROM (SELECT DISTINCT i FROM x)
  UNION ALL
  SELECT step + 1, i, u - {_ADAM_LR}{f} * (m1 / (1 - {_B1}{f} ** (step + 1))) / (sqrt(v1 / (1 - {_B2}{f} ** (step + 1))) + {_EPS}{f}),
         m1, v1, loss, n_docs
  FROM (SELECT step, i, u, {_B1}{f} * m + (1 - {_B1}{f}) * g AS m1, {_B2}{f} * v + (1 - {_B2}{f}) * g * g AS v1, loss, n_docs
        FROM (SELECT step, i, u, m, v, loss, n_docs, greatest(-{_ADAM_CLIP}{f}, least({_ADAM_CLIP}{f}, g)) AS g
              FROM (SELECT step, i, u, m, v, count(*) AS n_docs,
                           avg((1 / (1 + exp(-2 * z)) - pos) * x) + CASE WHEN i > 0 THEN {_ADAM_L2}{f} * u ELSE 0 END AS g,
                           avg(ln(1 + exp(CASE WHEN pos = 1 THEN -2 * z ELSE 2 * z END))) + {_ADAM_L2}{f} * any_value(uu) AS loss
                    FROM (SELECT a.step, a.i, a.u, a.m, a.v, x.x, x.pos,
                                 sum(a.u * x.x) OVER (PARTITION BY x.doc_id) AS z,
                                 sum(CASE WHEN a.i > 0 THEN a.u * a.u ELSE 0 END) OVER (PARTITION BY x.doc_id) AS uu
                          FROM adam a JOIN x ON a.i = x.i WHERE a.step < {steps}) q1
                    GROUP BY step, i, u, m, v) q2) q3) q4)"""


ADAM = [*TRUNC, REVIEWS, pooled_cte("trunc")]
_RECURSIVE = "WITH RECURSIVE " + ",\n".join([*ADAM, _adam_ctes(6)]) + "\n"

SQL["train_adam"] = _RECURSIVE + """
SELECT CAST(step AS BIGINT) AS iteration, max(n_docs) AS n_docs, round(max(loss), 6) AS loss,
       round(sum(CASE WHEN i > 0 THEN abs(u) ELSE 0 END), 6) AS weight_sum
FROM adam WHERE step > 0 GROUP BY step"""

SQL["adam_scores"] = _RECURSIVE + """,
az AS (SELECT p.doc_id, sum(p.m * a.u) + (SELECT u FROM adam WHERE step = 6 AND i = 0) AS z
       FROM pooled_long p JOIN adam a ON p.i = a.i WHERE a.step = 6 GROUP BY p.doc_id)
SELECT r.doc_id, r.split, r.sentiment AS actual, coalesce(n.n, 0) AS n,
       round(1 / (1 + exp(-2 * z)), 6) AS score_pos,
       CASE WHEN z IS NULL THEN NULL WHEN z >= 0 THEN 'Positive' ELSE 'Negative' END AS predicted
FROM reviews r LEFT JOIN az ON r.doc_id = az.doc_id LEFT JOIN doc_n n ON r.doc_id = n.doc_id"""

# ---------------------------------------------------------------- stored models and inputs: what must hold

SQL["inputs_ready"] = "SELECT * FROM (VALUES ('vectors', true), ('corpus', true), ('model', true)) t(input, present)"

SQL["seeded_training"] = """SELECT * FROM (VALUES ('logistic', true), ('centroid', true), ('adam', true), ('lstm', true))
t(model, identical)"""

SQL["model_roundtrip"] = """SELECT * FROM (VALUES ('logistic', true, false, true, NULL), ('adam', true, false, true, true),
('lstm', true, false, true, true)) t(model, trained_first, trained_second, reload_equal, resumed_equal)"""
