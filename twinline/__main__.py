from twinline.plans.stages import main

raise SystemExit(main())
