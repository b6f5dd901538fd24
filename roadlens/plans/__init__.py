"""The questions: standing analyses, variants, star-table demos, job runner, oracles."""
