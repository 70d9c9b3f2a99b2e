"""Readers: manifests, FASTQ, tool reports, alignments, annotation and stage tables."""
