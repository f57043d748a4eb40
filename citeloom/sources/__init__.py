"""Normalisers: landed payloads of each source to ``source_records`` rows.

Every normaliser takes the landing table ``raw_payloads(source, member_name, page_no, row_no, payload)``.
Nothing is fetched here.
"""
