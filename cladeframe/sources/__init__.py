"""Readers and writers of FASTA, SAM, VCF, GFF and TSV."""
