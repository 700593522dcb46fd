"""``python -m incidentlake --layer all`` runs the pipeline command line."""

from incidentlake.plans.pipeline import main

raise SystemExit(main())
