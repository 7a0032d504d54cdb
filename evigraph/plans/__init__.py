"""The query catalogue."""


def all_registries():
    from . import curation, dispositions, evidence, jobs, merging, more, pages, pairing, publishing, resolving, streams, training

    return [curation.R, dispositions.R, evidence.R, jobs.R, merging.R, more.R, pages.R, pairing.R, publishing.R, resolving.R, streams.R, training.R]
