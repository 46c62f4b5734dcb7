"""Decorated Markdown made from ``documents``; the same SQL runs in both engines."""

MD = """
SELECT doc_id, lang, source,
  '## Study ' || CAST(doc_id AS STRING) || chr(10) || chr(10)
  || 'J. Doe, A. Roe*' || chr(10) || chr(10)
  || CASE WHEN doc_id % 5 = 0 THEN '**1. Introduction**' ELSE '## 1. Introduction' END || chr(10) || chr(10)
  || 'Width 5 µ m, see [1] - [3] and ( 2 ), &amp; /uniFB01eld $x_{' || CAST(doc_id % 7 AS STRING) || '}$ , $y$.' || chr(10) || chr(10)
  || replace(text, chr(10), chr(10) || chr(10)) || chr(10) || chr(10)
  || CASE WHEN doc_id % 3 = 0 THEN '$$' || chr(10) || 'E = m c^{2' || CASE WHEN doc_id % 2 = 0 THEN '}' ELSE '' END || chr(10) || '$$' || chr(10) || chr(10) ELSE '' END
  || CASE WHEN doc_id % 4 = 0 THEN '![Figure 1](a/f1.png)' || chr(10) || chr(10) || '*Figure 1. Caption of ' || source || '*' || chr(10) || chr(10) ELSE '' END
  || CASE WHEN doc_id % 8 > 1 THEN '| ' || CASE WHEN doc_id % 16 > 11 THEN 'Col1' ELSE 'a' END || ' | b |' || chr(10) || '|---|---|' || chr(10) || repeat('| 1 | 2 |' || chr(10), CAST(doc_id % 8 AS INT)) || chr(10) ELSE '' END
  || '## 2. Results' || chr(10) || chr(10) || '© 2024 Publisher' || chr(10) || chr(10)
  || CASE WHEN doc_id % 6 = 0 THEN 'Downloaded from www.example.com' || chr(10) || chr(10) || 'Downloaded from www.example.com' || chr(10) || chr(10) ELSE '' END
  || CASE WHEN doc_id % 9 = 0 THEN 'e/uniFB03cient high/C0 speed ﬁlm' || chr(10) || '```' || chr(10) || 'a   b' || chr(10) || '```' || chr(10) || '| c   d |' || chr(10) || 'x   y ( 1 - 3, 5 ) \u00a0\uf061\uf06d\uf06a a/hairspace b 40 , 198 5 µ ma /formula-not-decoded' || chr(10) || chr(10) ELSE '' END
  || CASE WHEN doc_id % 10 = 0 THEN 'The film' || chr(10) || chr(10) || 'was grown on (Si)' || chr(10) || chr(10) || '(The next one)' || chr(10) || chr(10) || 'ends here.' || chr(10) || chr(10) || 'next' || chr(10) || chr(10) ELSE '' END
  || CASE WHEN doc_id % 11 = 0 THEN '[1] [,] [2] and [[4]] <sup>2</sup> a<sub>3</sub> <span id=1>s</span> A fi lm &lt;' || chr(10) || chr(10) || '# 3.1 Sub' || chr(10) || chr(10) || '# 4. Main' || chr(10) || chr(10) || 'see [−][3] or $x$nm' || chr(10) || chr(10) ELSE '' END
  || '## References' || chr(10) || chr(10)
  || repeat('[1] A. B. Author, Nano Lett. 2020, 1, 2.' || chr(10), CAST(doc_id % 30 AS INT)) AS md
FROM documents
"""
