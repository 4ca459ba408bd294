"""Training-data operators: near duplicates, language, toxicity, licences,
personal data, decontamination, chat formatting and tokenisation.

Nothing outside this package imports it.  ``queries.py`` registers one query
``opN_<name>`` per operator; ``corpus_pipeline.py`` at the repository top
chains five of them.
"""
