"""Small trace files, written for these tests."""

HEAD = """Trace file /diag/app_ora_1.trc
Database Release 1
Version 1.2.3
Node name:      db1.example.com
Instance name: app
Unix process pid: 77, image: server@db1
a line that no rule knows

*** 2024-03-01T10:00:00.000100+01:00 (PDB(3))
*** SESSION ID:(12.34) 2024-03-01T10:00:00.000200+01:00
*** CLIENT ID:(web) 2024-03-01T10:00:00.000300+01:00
*** MODULE NAME:(shop) 2024-03-01T10:00:00.000400+01:00
*** CONTAINER ID:(3) 2024-03-01T10:00:00.000500+01:00
"""

# One interaction with all kinds of calls: lines 14-31, then a commit.
SIMPLE = (
    HEAD
    + """=====================
PARSING IN CURSOR #4711 len=20 dep=0 uid=9 oct=3 lid=9 tim=1000 hv=77 ad='ab12' sqlid='stmt1'
select a
  from b
END OF STMT
PARSE #4711:c=5,e=6,p=0,cr=0,cu=0,mis=1,r=0,dep=0,og=1,plh=99,tim=1010
BINDS #4711:

 Bind#0
  value=1
EXEC #4711:c=7,e=8,p=0,cr=0,cu=0,mis=0,r=0,dep=0,og=1,plh=99,tim=1030
WAIT #4711: nam='db file sequential read' ela= 12 file#=1 block#=2 blocks=1 obj#=3 tim=1050
FETCH #4711:c=9,e=10,p=1,cr=4,cu=0,mis=0,r=3,dep=0,og=1,plh=99,tim=1060
FETCH #4711:c=1,e=2,p=0,cr=1,cu=0,mis=0,r=2,dep=0,og=1,plh=99,tim=1070
STAT #4711 id=1 cnt=5 pid=0 pos=1 obj=3 op='TABLE ACCESS FULL B'
CLOSE #4711:c=1,e=3,dep=0,type=2,tim=1080
XCTEND rlbk=0, rd_only=1, tim=1090
"""
)

# The cursor is used again without a parse, then after a reset, then reset twice in a row.
AGAIN = (
    SIMPLE
    + """EXEC #4711:c=1,e=1,tim=2000
EXEC #4711:c=1,e=1,tim=2010
FETCH #4711:c=1,e=1,r=1,tim=2020
=====================
WAIT #0: nam='SQL*Net message from client' ela= 500 driver id=1 #bytes=1 p3=0 obj#=-1 tim=2600
FETCH #4711:c=1,e=1,r=1,tim=2700
=====================
=====================
*** 2024-03-01T10:00:05.000000+01:00 (PDB(3))
CLOSE #4711:c=1,e=1,tim=2800
"""
)

# A wall clock line inside binds, broken items, short cursors, an error text, large objects.
ODD = (
    HEAD
    + """BINDS #4712:
 Bind#0
*** 2024-03-01T10:00:01.000000+01:00 (PDB(3))
  value=2
EXEC #4712:c=1,e=2,ti
EXEC #4712:c=1,e=2,,tim=3000
STAT #1 id=1 cnt=1
PARSING IN CURSOR #4713 len=20 dep=x uid=9 oct=3 lid=9 tim=3010 hv=77 ad
select 1
=====================
END OF STMT
END OF STMT
PARSE ERROR #4713:len=7 dep=0 uid=9 oct=3 lid=9 tim=3020 err=942
selec bad
=====================
ERROR #4713:err=942 tim=3030
LOBREAD: type=TEMPORARY LOB,bytes=5,c=1,e=4,p=0,cr=0,cu=7,tim=3040
LOBWRITE: type=PERSISTENT LOB,bytes=5,c=1,e=4,cu=
XCTEND rlbk=0, rd_only=1,
WAIT #4713: something else
*** ACTION NAME:(pay) 2024-03-01T10:00:02.000000
*** CLIENT ID:(late) 2024-03-01T08:00:03.000000-01:30
EXEC #4713:c=1,e=1,tim=3050
"""
)
