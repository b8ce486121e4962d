"""Hand-written record files."""

from __future__ import annotations

import gzip
import os
from xml.sax.saxutils import escape


def article(pmid, title="<ArticleTitle>T</ArticleTitle>", date="", abstract="", authors="",
            types="", chemicals="", headings="", data="", journal="", created=""):
    pmid_xml = "" if pmid is None else f'<PMID Version="1">{pmid}</PMID>'
    return f"""<PubmedArticle>
  <MedlineCitation Status="MEDLINE">
    {pmid_xml}
    {created}
    <Article PubModel="Print">
      <Journal>
        <JournalIssue><PubDate>{date}</PubDate></JournalIssue>{journal}
      </Journal>
      {title}
      {abstract}
      {authors}
      {types}
    </Article>
    {chemicals}
    {headings}
  </MedlineCitation>
  <PubmedData>{data}</PubmedData>
</PubmedArticle>"""


def book(pmid, title="<BookTitle>B</BookTitle>", date="", book_authors="", authors="",
         abstract=""):
    return f"""<PubmedBookArticle>
  <BookDocument>
    <PMID Version="1">{pmid}</PMID>
    <Book>{title}<PubDate>{date}</PubDate>{book_authors}</Book>
    {authors}
    {abstract}
  </BookDocument>
  <PubmedBookData/>
</PubmedBookArticle>"""


def deletes(*pmids):
    ids = "\n".join(f'  <PMID Version="1">{p}</PMID>' for p in pmids)
    return f"<DeleteCitation>\n{ids}\n</DeleteCitation>"


def titled(text):
    return f"<ArticleTitle>{escape(text)}</ArticleTitle>"


def write_file(folder, name, *records, root="PubmedArticleSet"):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    body = "\n".join(records)
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write(
            '<?xml version="1.0" encoding="utf-8"?>\n'
            f'<!DOCTYPE {root} SYSTEM "set.dtd">\n<{root}>\n{body}\n</{root}>\n'
        )
    return path
