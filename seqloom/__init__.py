"""seqloom: batch jobs on sequencing reads as Spark DataFrame operators."""
